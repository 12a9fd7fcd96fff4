"""Hyperlink graph: links of pages and crawl metadata, cleaned URLs, node index and edge list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcrawl.functions.urls import domain, registered_domain, resolve
from loomcrawl.operators.ranks import dense_ids

#: The part of a crawl-metadata envelope that link extraction reads; all other keys are ignored.
WAT_SCHEMA = (
    "Envelope struct<`WARC-Header-Metadata`: struct<`WARC-Type`: string, `WARC-Target-URI`: string>, "
    "`Payload-Metadata`: struct<`HTTP-Response-Metadata`: struct<Headers: struct<`Content-Type`: string>, "
    "`Response-Message`: struct<Status: string>, `HTML-Metadata`: struct<Links: array<struct<text: string, url: string, path: string>>>>>>"
)


#: A link's address in double, single or no quotes, wherever it stands among the attributes.
_HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def _unquoted(href: Column) -> Column:
    return F.when(href.rlike("^[\"']"), F.substring(href, F.lit(2), F.length(href) - 2)).otherwise(href)


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, url, href), one row per `<a href>` in page order, however it is quoted; pages without links give none."""
    return pages.select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit(_HREF), 1)).alias("href")).withColumn("href", _unquoted(F.col("href")))


def page_anchors(pages: DataFrame) -> DataFrame:
    """(page_id, url, target, anchor), one row per `<a href>` with its text without markup; white space collapsed."""
    pattern = F.lit(rf"{_HREF}[^>]*>(.*?)</a>")
    both = F.arrays_zip(F.regexp_extract_all("html", pattern, F.lit(1)).alias("target"), F.regexp_extract_all("html", pattern, F.lit(2)).alias("anchor"))
    x = pages.select("page_id", "url", F.explode(both).alias("x"))
    return x.select("page_id", "url", _unquoted(F.col("x.target")).alias("target"), F.trim(F.regexp_replace(F.regexp_replace("x.anchor", "<[^>]*>", ""), r"\s+", " ")).alias("anchor"))


def wat_records(lines: DataFrame) -> DataFrame:
    """Envelopes (type, uri, status, content_type, links) from text lines; lines that are not JSON objects are skipped."""
    e = F.from_json("value", WAT_SCHEMA)["Envelope"]
    http = e["Payload-Metadata"]["HTTP-Response-Metadata"]
    return (
        lines.where(F.col("value").startswith("{"))
        .select(e["WARC-Header-Metadata"].alias("h"), http.alias("p"))
        .select(
            F.col("h.`WARC-Type`").alias("type"),
            F.col("h.`WARC-Target-URI`").alias("uri"),
            F.expr("try_cast(p.`Response-Message`.Status as int)").alias("status"),
            F.col("p.Headers.`Content-Type`").alias("content_type"),
            F.col("p.`HTML-Metadata`.Links").alias("links"),
        )
    )


def _is_html() -> Column:
    return (F.col("type") == "response") & (F.col("status") == 200) & F.col("content_type").startswith("text/html") & (F.size("links") > 0)


def wat_adjacency(records: DataFrame) -> DataFrame:
    """(origin, links): href links of good html responses, backslashes escaped; a page whose links have no href keeps an empty array."""
    hrefs = F.filter("links", lambda x: x["path"].contains("href"))
    return records.where(_is_html()).select(F.col("uri").alias("origin"), F.transform(hrefs, lambda x: F.replace(x["url"], F.lit("\\"), F.lit("\\\\"))).alias("links"))


def wat_redirects(records: DataFrame) -> DataFrame:
    """Responses with a status from 300 to 399."""
    return records.where("type = 'response' and status >= 300 and status < 400")


def wat_counters(records: DataFrame) -> DataFrame:
    """Counters of link extraction, as one row."""
    ok = (F.col("type") == "response") & (F.col("status") == 200)
    html = ok & F.col("content_type").startswith("text/html")
    hrefs = F.size(F.filter(F.coalesce("links", F.array().cast("array<struct<text:string,url:string,path:string>>")), lambda x: x["path"].contains("href")))
    return records.agg(
        F.count_if(F.col("type") == "response").alias("responses"),
        F.count_if(ok).alias("ok"),
        F.count_if((F.col("type") == "response") & F.col("status").between(300, 399)).alias("redirects"),
        F.count_if(html).alias("html"),
        F.coalesce(F.sum(F.when(html, F.size("links"))), F.lit(0)).alias("links"),
        F.coalesce(F.sum(F.when(html, hrefs)), F.lit(0)).cast("long").alias("hrefs"),
    )


def clean_links(adjacency: DataFrame) -> DataFrame:
    """(origin, links) with links absolute: fragments, empty and malformed references dropped; origins that are not http are dropped."""
    links = F.transform("links", lambda x: resolve(x, F.col("origin")))
    return adjacency.where(F.col("origin").startswith("http")).select("origin", F.filter(links, lambda x: x.isNotNull()).alias("links"))


def parse_adjacency(lines: DataFrame) -> DataFrame:
    """(origin, links) from lines `origin TAB target TAB …`; lines without a target or with a blank origin are dropped."""
    parts = F.split("value", "\t")
    return lines.where(F.size(parts) > 1).select(parts[0].alias("origin"), F.slice(parts, F.lit(2), F.size(parts)).alias("links")).where("origin <> ''")


def edges(adjacency: DataFrame) -> DataFrame:
    """(origin, target), one row per link."""
    return adjacency.where(F.size("links") > 0).select("origin", F.explode("links").alias("target"))


def url_list(edge_list: DataFrame) -> DataFrame:
    """(url): all distinct ends of edges, sorted."""
    both = edge_list.select(F.col("origin").alias("url")).unionByName(edge_list.select(F.col("target").alias("url")))
    return both.distinct().orderBy("url")


def url_index(urls: DataFrame, offset: int = 0) -> DataFrame:
    """(url, id): ids are places in the sorted list, from offset; gapless."""
    return dense_ids(urls.select("url").distinct(), ["url"], "id").withColumn("id", F.col("id") + offset)


def index_edges(edge_list: DataFrame, index: DataFrame) -> DataFrame:
    """(origin, target) as ids; edges with an end that is not in the index are dropped.

    Spark broadcasts the index where it is small and joins by URL beyond that.
    """
    ids = lambda c: index.select(F.col("url").alias(c), F.col("id").alias(f"{c}_id"))
    return edge_list.join(ids("origin"), "origin").join(ids("target"), "target").select(F.col("origin_id").alias("origin"), F.col("target_id").alias("target"))


def index_edges_keep(edge_list: DataFrame, index: DataFrame) -> DataFrame:
    """(origin, target) as strings: the id where the index has the URL, else the text; whole numbers pass through."""
    out = edge_list
    for c in ("origin", "target"):
        ids = index.select(F.col("url").alias(c), F.col("id").alias(f"{c}_id"))
        known = F.coalesce(F.expr(f"cast(try_cast({c} as bigint) as string)"), F.col(f"{c}_id").cast("string"), F.col(c))
        out = out.join(ids, c, "left").withColumn(c, known).drop(f"{c}_id")
    return out.select("origin", "target")


def distinct_edges(edge_list: DataFrame) -> DataFrame:
    return edge_list.distinct().orderBy("origin", "target")


def host_edges(edge_list: DataFrame) -> DataFrame:
    """(origin, target, links) between hosts."""
    return edge_list.groupBy(domain(F.col("origin")).alias("origin"), domain(F.col("target")).alias("target")).agg(F.count("*").alias("links"))


# Queries over the test tables. `pages` has root-relative links alone, so other kinds of references are added to it.


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def _references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(origin, href): links of pages, and five constructed references per page."""
    pages = _pages(spark, sf_dir)
    made = F.array(
        F.concat(F.lit("http://other.example.net/p/"), F.col("page_id").cast("string")),
        F.concat(F.lit("#"), F.col("page_id").cast("string")),
        F.lit(""),
        F.lit("?q=1"),
        F.concat(F.lit("../up/"), (F.col("page_id") % 7).cast("string")),
    )
    return page_links(pages).select(F.col("url").alias("origin"), "href").unionByName(pages.select(F.col("url").alias("origin"), F.explode(made).alias("href")))


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _references(spark, sf_dir).select("origin", resolve(F.col("href"), F.col("origin")).alias("target")).where("target is not null")


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all origins and of the targets of even length, so that both hits and misses occur."""
    e = _edges(spark, sf_dir)
    urls = e.select(F.col("origin").alias("url")).unionByName(e.select(F.col("target").alias("url")).where("length(url) % 2 = 0"))
    return url_index(urls)


def target_indegree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty link targets with the most links, ties by host and path."""
    links = page_links(_pages(spark, sf_dir))
    by = links.groupBy(domain(F.col("url")).alias("host"), F.col("href").alias("path"))
    return by.agg(F.count("*").alias("links"), F.countDistinct("page_id").alias("pages")).orderBy(F.desc("links"), "host", "path").limit(20)


def anchor_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_anchors(_pages(spark, sf_dir)).groupBy("target", "anchor").agg(F.countDistinct("page_id").alias("pages"))


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by registered domain."""
    return _pages(spark, sf_dir).groupBy(registered_domain(F.col("url")).alias("site")).agg(F.count("*").alias("pages"), F.countDistinct(domain(F.col("url"))).alias("hosts"))


def link_quoting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of pages whose every third has single quotes and another attribute before, and whose every third has no quotes."""
    pages = _pages(spark, sf_dir)
    single = F.regexp_replace("html", '<a href="([^"]*)"', "<A class=\"x\"\n HREF = '$1' id=y")
    bare = F.regexp_replace("html", '<a href="([^" ]*)"', "<a data-href='no' href=$1")
    html = F.when(F.col("page_id") % 3 == 1, single).when(F.col("page_id") % 3 == 2, bare).otherwise(F.col("html"))
    return page_links(pages.withColumn("html", html)).select("page_id", "href")


def link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = page_links(_pages(spark, sf_dir))
    return links.select("page_id", domain(F.col("url")).alias("host"), "href")


def link_clean_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges(spark, sf_dir).groupBy("origin", "target").agg(F.count("*").alias("links"))


def url_distinct_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_list(_edges(spark, sf_dir))


def url_index_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_index(url_list(_edges(spark, sf_dir)), 100)


def edge_index_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_edges(_edges(spark, sf_dir), _index(spark, sf_dir))


def edge_index_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_edges_keep(_edges(spark, sf_dir), _index(spark, sf_dir))


def edge_distinct_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_edges(_edges(spark, sf_dir))


def host_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_edges(_edges(spark, sf_dir))


def _wat_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl-metadata lines built from pages: every kind of record that the filters tell apart occurs."""
    links = page_links(_pages(spark, sf_dir)).groupBy("page_id").agg(F.collect_list(F.struct(F.lit(None).cast("string").alias("text"), F.col("href").alias("url"), F.when(F.length("href") % 3 == 0, "IMG@/src").otherwise("A@/href").alias("path"))).alias("links"))
    p = _pages(spark, sf_dir).join(links, "page_id", "left")
    kind = F.when(F.col("page_id") % 11 == 0, "request").otherwise("response")
    status = F.when(F.col("page_id") % 7 == 0, "301").when(F.col("page_id") % 13 == 0, "404").otherwise("200")
    content = F.when(F.col("page_id") % 5 == 0, "application/pdf").otherwise("text/html; charset=utf-8")
    envelope = F.struct(
        F.struct(
            F.struct(kind.alias("WARC-Type"), F.col("url").alias("WARC-Target-URI")).alias("WARC-Header-Metadata"),
            F.struct(F.struct(F.struct(content.alias("Content-Type")).alias("Headers"), F.struct(status.alias("Status")).alias("Response-Message"), F.struct(F.col("links").alias("Links")).alias("HTML-Metadata")).alias("HTTP-Response-Metadata")).alias("Payload-Metadata"),
        ).alias("Envelope")
    )
    junk = p.select(F.concat(F.lit("WARC/1.0 "), F.col("url")).alias("value"))
    return p.select(F.to_json(envelope).alias("value")).unionByName(junk)


def wat_filter_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wat_adjacency(wat_records(_wat_lines(spark, sf_dir))).select("origin", F.explode_outer("links").alias("target"))


def wat_redirect_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wat_redirects(wat_records(_wat_lines(spark, sf_dir))).select("uri", "status")


def wat_link_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wat_counters(wat_records(_wat_lines(spark, sf_dir)))


QUERIES = {f.__name__: f for f in (target_indegree, anchor_texts, site_pages, link_extract, link_quoting, link_clean_resolve, url_distinct_sorted, url_index_ids, edge_index_inner, edge_index_keep, edge_distinct_sorted, host_graph, wat_filter_links, wat_redirect_uris, wat_link_counters)}

_LINKS = """l as (select page_id, url as origin, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as href from pages)"""
_HOST = "lower(regexp_extract({}, '^https?://(?:[^/?#@]*@)?([^/?#:@]+)', 1))"
_EDGES = f"""{_LINKS},
    b as (select page_id, url as origin, regexp_extract(url, '^(https?://[^/?#]+)', 1) as site, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) as path from pages),
    e as (
        select l.origin, b.site || l.href as target from l join b on l.page_id = b.page_id
        union all select origin, 'http://other.example.net/p/' || page_id from b
        union all select origin, site || path || '?q=1' from b
        union all select origin, site || regexp_replace(path, '[^/]*/[^/]*$', '') || 'up/' || (page_id % 7) from b)"""
_WAT = f"""{_LINKS},
    r as (select page_id, url, case when page_id % 11 = 0 then 'request' else 'response' end as type,
                 case when page_id % 7 = 0 then 301 when page_id % 13 = 0 then 404 else 200 end as status, page_id % 5 <> 0 as html from pages),
    good as (select * from r where type = 'response' and status = 200 and html and page_id in (select page_id from l))"""
_INDEX = "i as (select url, row_number() over (order by url) - 1 as id from (select origin as url from e union select target from e where length(target) % 2 = 0))"
ORACLE_SQL = {
    "target_indegree": f"""with {_LINKS} select {_HOST.format("origin")} as host, href as path, count(*) as links, count(distinct page_id) as pages
        from l group by 1, 2 order by links desc, host, path limit 20""",
    "anchor_texts": """with a as (select page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) as target, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) as anchor from pages)
        select target, trim(anchor) as anchor, count(distinct page_id) as pages from a group by 1, 2""",
    "site_pages": f"""with h as (select {_HOST.format("url")} as host from pages), p as (select host, str_split(host, '.') as x from h)
        select x[-2] || '.' || x[-1] as site, count(*) as pages, count(distinct host) as hosts from p group by 1""",
    "link_quoting": f"with {_LINKS} select page_id, href from l",
    "link_extract": f"with {_LINKS} select page_id, {_HOST.format('origin')} as host, href from l",
    "link_clean_resolve": f"with {_EDGES} select origin, target, count(*) as links from e group by 1, 2",
    "url_distinct_sorted": f"with {_EDGES} select origin as url from e union select target from e order by 1",
    "url_index_ids": f"with {_EDGES} select url, row_number() over (order by url) + 99 as id from (select origin as url from e union select target from e)",
    "edge_index_inner": f"with {_EDGES}, {_INDEX} select o.id as origin, t.id as target from e join i o on e.origin = o.url join i t on e.target = t.url",
    "edge_index_keep": f"with {_EDGES}, {_INDEX} select coalesce(o.id::varchar, e.origin) as origin, coalesce(t.id::varchar, e.target) as target from e left join i o on e.origin = o.url left join i t on e.target = t.url",
    "edge_distinct_sorted": f"with {_EDGES} select distinct origin, target from e order by 1, 2",
    "host_graph": f"with {_EDGES} select {_HOST.format('origin')} as origin, {_HOST.format('target')} as target, count(*) as links from e group by 1, 2",
    "wat_filter_links": f"with {_WAT} select good.url as origin, x.href as target from good left join (select * from l where length(href) % 3 <> 0) x on x.page_id = good.page_id",
    "wat_redirect_uris": f"with {_WAT} select url as uri, status::int as status from r where type = 'response' and status between 300 and 399",
    "wat_link_counters": f"""with {_WAT} select (select count(*) from r where type = 'response') as responses, (select count(*) from r where type = 'response' and status = 200) as ok,
        (select count(*) from r where type = 'response' and status between 300 and 399) as redirects, (select count(*) from r where type = 'response' and status = 200 and html) as html,
        (select count(*) from l join r using (page_id) where type = 'response' and status = 200 and html) as links,
        (select count(*) from l join r using (page_id) where type = 'response' and status = 200 and html and length(href) % 3 <> 0) as hrefs""",
}
