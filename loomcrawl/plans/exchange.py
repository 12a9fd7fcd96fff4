"""Queries over what is written and read back: archives, statistics, link lists, lookups, maps and dumps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcrawl.functions.text import human_bytes, shorten
from loomcrawl.functions.urls import path_terms
from loomcrawl.operators import links, quads
from loomcrawl.operators.cooc import pair_supports_with_domains
from loomcrawl.operators.profile import attribute_union, merge_counters
from loomcrawl.operators.scratch import scratch_path
from loomcrawl.sources import archives, chunks, sinks, text


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _response(html: Column) -> Column:
    return F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nLast-Modified: today\r\n\r\n"), html)


def _archived(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The HTML responses of an archive of all pages."""
    pages = _table(spark, sf_dir, "pages").select("url", _response(F.coalesce("html", F.lit(""))).alias("content"))
    size = F.octet_length("content").cast("string")
    head = {
        "warc": F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), "url", F.lit("\r\nContent-Length: "), size, F.lit("\r\n\r\n")),
        "arc": F.concat("url", F.lit(" 192.0.2.1 20200102030405 text/html "), size, F.lit("\n")),
    }[kind]
    path = scratch_path(spark, f"pages-{kind}")
    pages.select(F.concat(head, "content").alias("value")).write.option("lineSep", "\r\n\r\n" if kind == "warc" else "\n").option("compression", "gzip").text(path)
    archives.register(spark)
    found = archives.html_responses(spark.read.format(kind).load(path))
    return found.select("uri", "status", "content_type", "last_modified", F.md5("html").alias("html_md5"))


def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _archived(spark, sf_dir, "warc")


def arc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _archived(spark, sf_dir, "arc")


def arc_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as ARC records with a broken line after every third one, which the tolerant reader passes over."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    head = F.concat("url", F.lit(" 192.0.2.1 20200102030405 text/html "), F.octet_length("html").cast("string"), F.lit("\n"))
    junk = F.when(F.col("page_id") % 3 == 0, "\nthis is no header").otherwise("")
    path = scratch_path(spark, "pages-junk")
    pages.select(F.concat(head, "html", junk).alias("value")).write.option("compression", "gzip").text(path)
    archives.register(spark)
    found = spark.read.format("arc").option("tolerant", True).load(path)
    return found.select("uri", "mime", F.length("content").cast("long").alias("bytes"), F.col("error").isNotNull().alias("broken"))


def redirect_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redirects as lines of a uri and its metadata, quotes doubled; every fifth line's metadata is cut off."""
    status = F.element_at(F.array(F.lit("301"), F.lit("302"), F.lit("200")), (F.col("c_custkey") % 3 + 1).cast("int"))
    uri = F.concat(F.lit('http://c.example.org/"q"/'), F.col("c_custkey").cast("string"))
    envelope = F.to_json(F.struct(F.struct(
        F.struct(F.lit("response").alias("WARC-Type"), uri.alias("WARC-Target-URI")).alias("WARC-Header-Metadata"),
        F.struct(F.struct(F.struct(F.lit("text/html").alias("Content-Type")).alias("Headers"), F.struct(status.alias("Status")).alias("Response-Message")).alias("HTTP-Response-Metadata")).alias("Payload-Metadata"),
    ).alias("Envelope")))
    cut = F.when(F.col("c_custkey") % 5 == 0, F.substring(envelope, 2, 30)).otherwise(envelope)
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    path = scratch_path(spark, "redirects")
    _table(spark, sf_dir, "customer").select(F.concat(quoted(uri), F.lit(","), quoted(cut)).alias("value")).write.text(path)
    return links.wat_redirects(text.redirects(spark, path)).select("uri", "status")


def warc_by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as one archive, a member a record, and a third of its records fetched by an index, in tasks of 64 KB of it. Pages of one url lie in the order of their ids, those without one at the end."""
    pages = _table(spark, sf_dir, "pages")
    path, index = scratch_path(spark, "pages-archive"), scratch_path(spark, "pages-index")
    rows = pages.select("page_id", F.lit("response").alias("type"), F.col("url").alias("uri"), F.lit("2020-01-02T03:04:05Z").alias("ts"), F.lit("application/http").alias("mime"), F.encode(_response(F.coalesce("html", F.lit(""))), "UTF-8").alias("content"))
    archives.register(spark)
    rows.coalesce(1).sortWithinPartitions(F.asc_nulls_last("uri"), "page_id").drop("page_id").write.format("warc").mode("append").save(path)
    archives.index_records(spark.read.format("warc").load(path)).write.parquet(index)
    wanted = spark.read.parquet(index).where("substr(md5(uri), 1, 1) < '5'")
    found = archives.fetch_records(wanted, task_bytes=64 << 10)
    return found.select("uri", "offset", (F.col("end_offset") - F.col("offset")).alias("bytes"), F.md5(F.expr("substring(content, locate('\r\n\r\n', decode(content, 'iso-8859-1')) + 4, length(content))")).alias("html_md5"))


def quad_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements and broken lines as chunks of 20,000 packed bytes at most, read back: lines by extractor, and what was counted."""
    path = scratch_path(spark, "chunks")
    chunks.write_chunks(quads._customer_lines(spark, sf_dir), path, 20_000, 5_000)
    files = text.listing(spark, path, ".nq.gz").agg((F.max("bytes") <= 20_000).alias("bounded"))
    lines = chunks.read_chunks(spark, path).groupBy(F.regexp_extract("value", "<ex:([^<>]+)> [.]$", 1).alias("extractor")).agg(F.count("*").alias("quads"))
    counts = chunks.chunk_counts(spark, path).select("lines", "unknown", "unparsable")
    one = lambda df: df.withColumn("one", F.lit(1))
    return one(lines).join(one(counts), "one").join(one(files), "one").drop("one")


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics as CSV and back; the name has quotes and commas."""
    path = scratch_path(spark, "csv")
    sinks.write_csv(_table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit('say "x", '), "c_name").alias("c_name"), "c_mktsegment"), path)
    return text.csv_lines(spark, path).select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", "c_mktsegment")


def adjacency_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an adjacency list: a customer's segment and the customers in it."""
    c, path = _table(spark, sf_dir, "customer"), scratch_path(spark, "adjacency")
    sinks.write_adjacency(c.groupBy(F.concat("c_mktsegment", F.lit("-"), F.col("c_nationkey").cast("string")).alias("origin")).agg(F.sort_array(F.collect_set("c_name")).alias("links")), path)
    return text.adjacency(spark, path).select("origin", F.array_join("links", "|").alias("links"))


def edge_text_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "edges")
    sinks.write_edges(_table(spark, sf_dir, "supplier").select(F.col("s_name").alias("origin"), F.col("s_nationkey").cast("string").alias("target")), path)
    return text.edge_text(spark, path)


def key_value_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by key, as JSON; five keys are looked up."""
    path = scratch_path(spark, "key-value")
    sinks.write_key_value(_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey"), path, "o_orderkey")
    found = sinks.read_key_value(spark, path, [1, 2, 3, 500, 999_999_999])
    return found.select("key", F.get_json_object("json", "$.o_orderstatus").alias("status"), F.get_json_object("json", "$.o_custkey").cast("long").alias("customer"))


def labelled_pages_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "labelled")
    pages = _table(spark, sf_dir, "pages")
    sinks.write_labelled_pages(pages.select(F.col("url").alias("uri"), F.lit("text/html").alias("content_type"), F.when(F.col("page_id") % 2 == 0, "even").otherwise("odd").alias("class"), F.col("html").alias("content")), path)
    back = spark.read.schema("uri string, content_type string, class string, content string").json(path)
    return back.select("uri", "content_type", "class", F.md5("content").alias("content_md5"))


def record_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of the benchmark, a line each, dumped in files of seven records at most: how many files have how many."""
    path = scratch_path(spark, "dump")
    sinks.write_record_dump(_table(spark, sf_dir, "benchmark").coalesce(1).select(F.regexp_replace("text", r"\s+", " ").alias("text")), path, 7)
    sizes = spark.read.text(path).where("value <> ''").groupBy(F.input_file_name()).agg(F.count("*").alias("records"))
    return sizes.groupBy("records").agg(F.count("*").alias("files"))


def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a folder that has one for each nation of customers, by listing."""
    path = scratch_path(spark, "listed")
    _table(spark, sf_dir, "customer").repartition("c_nationkey").write.partitionBy("c_nationkey").csv(path)
    nation = F.regexp_extract("path", "c_nationkey=([0-9]+)", 1).cast("int")
    return text.listing(spark, path, ".csv").groupBy(nation.alias("nation")).agg(F.count("*").alias("files"), (F.min("bytes") > 0).alias("filled"))


def class_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "classes")
    _table(spark, sf_dir, "pages").select("url", F.concat(F.lit("class "), F.col("page_id") % 3)).write.csv(path, sep="\t")
    return text.url_classes(spark, path)


def segment_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of all customers in the order in which they first come, by key."""
    path = scratch_path(spark, "segments")
    c = _table(spark, sf_dir, "customer").coalesce(1).sortWithinPartitions("c_custkey")
    c.select(F.concat(F.lit("  "), F.when(F.col("c_nationkey") == 3, "").otherwise(F.col("c_mktsegment")))).write.text(path)
    return text.segments(spark, path)


def corpus_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a corpus of gzip files by status, and how many lines those of each have; a frequent status has many files, so that no task writes or sorts it whole."""
    path = scratch_path(spark, "corpus")
    _table(spark, sf_dir, "orders").select("o_orderstatus", F.to_json(F.struct("o_orderkey", "o_totalprice")).alias("value")).hint("rebalance", "o_orderstatus").write.partitionBy("o_orderstatus").option("compression", "gzip").text(path)
    files = text.corpus_files(spark, path)
    return files.groupBy(F.regexp_extract("file", "o_orderstatus=([A-Z])", 1).alias("status")).agg(F.sum("lines").alias("lines"), F.max("error").alias("error"))


def report_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a report of 100 rows a page, read back: rows and first name of every page."""
    path = scratch_path(spark, "report")
    sinks.write_report_pages(_table(spark, sf_dir, "customer").select("c_name", "c_mktsegment"), path, ["c_name"], 100)
    page = spark.read.text(path, wholetext=True)
    return page.select(F.col("page").cast("long").alias("page"), F.size(F.regexp_extract_all("value", F.lit("<tr><td>"), 0)).cast("long").alias("rows"), F.regexp_extract("value", "<tr><td>([^<]*)</td>", 1).alias("first"))


def merged_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    return merge_counters(o.groupBy(F.col("o_orderstatus").alias("counter")).agg(F.count("*").alias("n")), o.select(F.col("o_orderpriority").alias("counter"), F.lit(1).cast("long").alias("n")), o.select(F.lit("F").alias("counter"), F.lit(2).cast("long").alias("n")))


def attribute_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    return attribute_union(e.select(F.create_map(F.col("event_type"), F.col("value"), F.concat(F.lit("user"), F.col("user_id") % 7), F.col("value")).alias("m")), "m")


def cooc_pairs_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands ordered together, with the two return flags that most of such orders have."""
    x = _table(spark, sf_dir, "lineitem").join(_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    pairs = pair_supports_with_domains(x.select("l_orderkey", "p_brand", "l_returnflag"), "l_orderkey", "p_brand", "l_returnflag", 2)
    return pairs.select("a", "b", "support", F.explode("top").alias("t")).select("a", "b", "support", F.col("t.place").cast("long").alias("place"), F.col("t.l_returnflag").alias("flag"), F.col("t.n").alias("n"))


def url_path_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", F.array_join(path_terms(F.concat(F.regexp_extract("url", "^([^?#]*)", 1), F.lit("/some-long_name%20here/index.HTML"))), "|").alias("terms"))


def shown_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and texts as they are shown to people."""
    return _table(spark, sf_dir, "documents").select("doc_id", human_bytes(F.col("n_chars").cast("long")).alias("size"), human_bytes(F.col("n_chars").cast("long"), True).alias("si"), shorten(F.col("text"), 40).alias("short"))


QUERIES = {
    f.__name__: f
    for f in (
        warc_round_trip, arc_round_trip, arc_tolerant, redirect_csv, warc_by_index, quad_chunks, csv_round_trip, adjacency_text, edge_text_round_trip, key_value_lookup, labelled_pages_round_trip, record_dump, listed_files,
        class_map, segment_list, corpus_files, report_pages, merged_counters, attribute_names, cooc_pairs_by_flag, url_path_terms, shown_texts,
    )
}
_PAGES = "select url as uri, 200::int as status, 'text/html; charset=utf-8' as content_type, 'today' as last_modified, md5(coalesce(html, '')) as html_md5 from pages"
def _bytes(unit: int, thousand: str, million: str) -> str:
    """In tenths of a unit, by whole numbers, a half up."""
    tenths = lambda u: f"((n_chars * 10 + {u // 2}) // {u})"
    shown = lambda u, name: f"{tenths(u)} // 10 || '.' || {tenths(u)} % 10 || ' {name}'"
    return f"case when n_chars < {unit} then n_chars || ' B' when n_chars < {unit**2} then {shown(unit, thousand)} else {shown(unit**2, million)} end"


ORACLE_SQL = {
    "warc_round_trip": _PAGES,
    "arc_round_trip": _PAGES,
    "arc_tolerant": "select url as uri, 'text/html' as mime, strlen(coalesce(html, ''))::bigint as bytes, false as broken from pages",
    "redirect_csv": "select 'http://c.example.org/\"q\"/' || c_custkey as uri, case c_custkey % 3 when 0 then 301 else 302 end as status from customer where c_custkey % 3 < 2 and c_custkey % 5 > 0",
    "warc_by_index": """with p as (select url as uri, strlen('HTTP/1.1 200 OK') + 2 + strlen('Content-Type: text/html; charset=utf-8') + 2 + strlen('Last-Modified: today') + 4 + strlen(coalesce(html, '')) as n, md5(coalesce(html, '')) as html_md5 from pages),
        s as (select uri, html_md5, strlen('WARC/1.0') + 2 + strlen('WARC-Type: response') + 2 + strlen('WARC-Target-URI: ' || uri) + 2 + strlen('WARC-Date: 2020-01-02T03:04:05Z') + 2 + strlen('Content-Type: application/http') + 2 + strlen('Content-Length: ' || n) + 4 + n as bytes from p)
        select uri, bytes, html_md5, coalesce(sum(bytes + 4) over (order by uri rows between unbounded preceding and 1 preceding), 0)::bigint as offset from s qualify substr(md5(uri), 1, 1) < '5'""",
    "quad_chunks": """with n as (select count(*) filter (c_custkey % 10 = 0) as cut, count(*) filter (c_custkey % 50 = 0) as notes, count(*) filter (c_custkey % 4 = 3) as odd, count(*) as n from customer)
        select ['html-microdata', 'html-rdfa', 'rdf-jsonld'][c_custkey % 4 + 1] as extractor, 5 * count(*) as quads, 5 * (n - odd) as lines, 5 * odd as unknown, cut + notes as unparsable, true as bounded
        from customer, n where c_custkey % 4 < 3 group by all""",
    "csv_round_trip": """select c_custkey, 'say "x", ' || c_name as c_name, c_mktsegment from customer""",
    "adjacency_text": "select o as origin, string_agg(c_name, '|' order by c_name) as links from (select distinct c_mktsegment || '-' || c_nationkey as o, c_name from customer) group by o",
    "edge_text_round_trip": "select s_name as origin, s_nationkey::varchar as target from supplier",
    "key_value_lookup": "select o_orderkey as key, o_orderstatus as status, o_custkey as customer from orders where o_orderkey in (1, 2, 3, 500, 999999999)",
    "labelled_pages_round_trip": "select url as uri, 'text/html' as content_type, case when page_id % 2 = 0 then 'even' else 'odd' end as class, md5(html) as content_md5 from pages",
    "record_dump": "with n as (select count(*) as n from benchmark where trim(text) <> '') select 7::bigint as records, n // 7 as files from n where n >= 7 union all select n % 7, 1 from n where n % 7 > 0",
    "listed_files": "select c_nationkey::int as nation, 1::bigint as files, true as filled from customer group by 1",
    "class_map": "select url, 'class ' || (page_id % 3) as class from pages",
    "segment_list": "select row_number() over (order by min(c_custkey)) - 1 as place, c_mktsegment as segment from customer where c_nationkey <> 3 group by c_mktsegment",
    "corpus_files": "select o_orderstatus as status, count(*) as lines, null::varchar as error from orders group by 1",
    "report_pages": "with p as (select c_name, (row_number() over (order by c_name) - 1) // 100 as page from customer) select page, count(*) as rows, min(c_name) as first from p group by page",
    "merged_counters": "select counter, sum(n)::bigint as n from (select o_orderstatus as counter, 1 as n from orders union all select o_orderpriority, 1 from orders union all select 'F', 2 from orders) group by 1",
    "attribute_names": "select event_type as attribute from events union select 'user' || (user_id % 7) from events",
    "cooc_pairs_by_flag": """with b as (select distinct l_orderkey, l_returnflag as flag, p_brand from lineitem join part on l_partkey = p_partkey),
        n as (select x.p_brand as a, y.p_brand as b, x.flag, count(*) as n from b x join b y on x.l_orderkey = y.l_orderkey and x.flag = y.flag and x.p_brand < y.p_brand group by 1, 2, 3),
        r as (select *, row_number() over (partition by a, b order by n desc, flag) as place, sum(n) over (partition by a, b)::bigint as support from n)
        select a, b, support, place, flag, n from r where place <= 2""",
    "url_path_terms": r"""select page_id, array_to_string(list_filter(regexp_split_to_array(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) || '/some-long_name%20here/index', '/|_|-|%20'), lambda x: x <> ''), '|') as terms from pages""",
    "shown_texts": f"""select doc_id, {_bytes(1024, 'KiB', 'MiB')} as size, {_bytes(1000, 'kB', 'MB')} as si,
        case when length(text) > 40 then substr(text, 1, 40) || ' ...' else text end as short from documents""",
}
