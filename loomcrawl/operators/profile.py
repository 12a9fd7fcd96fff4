"""Aggregates over crawl statistics: job totals, per-format profiles, heavy hitters, descriptive statistics, path roll-ups, rate windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcrawl.functions.urls import domain
from loomcrawl.operators.scratch import scratch_path


def job_totals(stats: DataFrame) -> DataFrame:
    """One row from job rows (pages_total, pages_parsed, pages_triples, size, duration in ms, rate); the mean rate leaves NaN and infinities out."""
    finite = ~F.isnan("rate") & (F.abs("rate") != float("inf"))
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("pages_total", "pages_parsed", "pages_triples", "size")]
    return stats.agg(*sums, F.avg(F.when(finite, F.col("rate"))).alias("mean_rate"), (F.sum("duration") / 60000.0).alias("cpu_minutes"))


def long_profile(pages: DataFrame, formats: list[str], total: str = "total_triples", meta: str = "html_head_meta") -> DataFrame:
    """(uri, domain, format, triples), one row per page and format with a statement, of pages with more than head metadata.

    A null count is 0. Rows are unpivoted by one expression; nothing is shuffled.
    """
    kept = pages.where(F.coalesce(F.col(total), F.lit(0)) - F.coalesce(F.col(meta), F.lit(0)) >= 1)
    pairs = F.array(*(F.struct(F.lit(f).alias("format"), F.coalesce(F.col(f"`{f}`"), F.lit(0)).cast("long").alias("triples")) for f in formats))
    x = kept.select("uri", domain(F.col("uri")).alias("domain"), F.explode(F.filter(pairs, lambda y: y["triples"] >= 1)).alias("x"))
    return x.select("uri", "domain", "x.format", "x.triples")


def format_profile(long: DataFrame) -> DataFrame:
    """Per format: triples, urls, domains and their mean triples; two levels, by domain and then by format."""
    by_domain = long.groupBy("format", "domain").agg(F.sum("triples").alias("triples"), F.count("*").alias("urls"))
    out = by_domain.groupBy("format").agg(F.sum("triples").alias("triples"), F.sum("urls").alias("urls"), F.count("*").alias("domains"))
    return out.withColumn("triples_per_url", F.col("triples") / F.col("urls")).withColumn("triples_per_domain", F.col("triples") / F.col("domains"))


def top_k(df: DataFrame, key: str, weight: Column, k: int) -> DataFrame:
    """(key, n): exact heavy hitters, ties by key; one partial heap of k rows per task."""
    return df.groupBy(key).agg(F.sum(weight).alias("n")).orderBy(F.desc("n"), key).limit(k)


def top_k_per(df: DataFrame, group: str, key: str, weight: Column, k: int) -> DataFrame:
    """(group, key, n, place) for the k heaviest keys of each group; Spark prunes to k rows per task before the shuffle."""
    counts = df.groupBy(group, key).agg(F.sum(weight).alias("n"))
    return counts.selectExpr("*", f"row_number() over (partition by {group} order by n desc, {key}) as place").where(F.col("place") <= k)


def top_k_lossy(df: DataFrame, key: str, k: int, tracked: int = 10_000) -> DataFrame:
    """(key, n) by Spark's sketch of frequent items: fixed memory, counts may be low."""
    got = df.agg(F.expr(f"approx_top_k({key}, {int(k)}, {int(tracked)})").alias("t"))
    return got.select(F.explode("t").alias("t")).select(F.col("t.item").alias(key), F.col("t.count").alias("n"))


def hitter_sketches(df: DataFrame, key: str, by: list[str] = (), tracked: int = 10_000) -> DataFrame:
    """(*by, sketch): a sketch of the frequent values of a column for each group, as a column that can be written and merged later."""
    return df.groupBy(*by).agg(F.expr(f"approx_top_k_accumulate(`{key}`, {int(tracked)})").alias("sketch"))


def merged_sketches(sketches: DataFrame, by: list[str] = (), tracked: int = 10_000) -> DataFrame:
    """(*by, sketch): sketches of several days or parts as one. No sketches: no row."""
    keys = [F.col(c) for c in by] or [F.lit(0).alias("_all")]
    return sketches.groupBy(*keys).agg(F.expr(f"approx_top_k_combine(sketch, {int(tracked)})").alias("sketch")).select(*by, "sketch")


def sketched_hitters(sketches: DataFrame, key: str, k: int, by: list[str] = (), tracked: int = 10_000) -> DataFrame:
    """(*by, key, n): the k most frequent values that each sketch knows, in order of n and value; tracked: as it was made with.

    Of N rows in a sketch of t tracked values, n is off by hitter_error(N, t) at most, and every value that occurs more often
    than that is known. With fewer distinct values than three quarters of t, counts are exact.
    """
    known = sketches.select(*by, F.explode(F.expr(f"approx_top_k_estimate(sketch, {int(tracked)})")).alias("t")).select(*by, F.col("t.item").alias(key), F.col("t.count").alias("n"))
    if not by:
        return known.orderBy(F.desc("n"), key).limit(k)
    return known.selectExpr("*", f"row_number() over (partition by {', '.join(by)} order by n desc, {key}) as place").where(F.col("place") <= k).drop("place")


def hitter_error(rows: int, tracked: int) -> int:
    """How far counts of a sketch may be off, merged or not: 3.5 times the rows over the size of its table, a power of two of `tracked` or more."""
    return int(3.5 * rows / (1 << max(3, (tracked - 1).bit_length()))) + 1


def describe(df: DataFrame, value: str, by: list[str] = ()) -> DataFrame:
    """min, max, mean, exact median and count of a column, by the groups given."""
    c = F.col(value)
    return df.groupBy(*by).agg(F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"), F.median(c).alias("median"), F.count(c).alias("n"))


def path_rollup(objects: DataFrame, path: str, size: str, separator: str = "/") -> DataFrame:
    """(prefix, files, bytes): sums for every prefix of every path, itself included."""
    parts = F.split(path, separator)
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), separator))
    return objects.select(F.explode(prefixes).alias("prefix"), F.col(size).alias("size")).groupBy("prefix").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))


def rate_window(samples: DataFrame, ts: str, value: str, by: str | None = None, seconds: int = 120, slices: int = 8) -> DataFrame:
    """Per sample: the value of the oldest sample of the last `seconds`, the fall per second since then, and the time left at that rate.

    `by`: each series has windows of its own; without it all samples are one series. A series is cut into slices
    of `slices` times the window's length, and a slice is read with a halo, the samples of one window before it: every sample
    is answered in its own slice, which has all that it looks back to. So tasks hold a slice and its halo, however long
    the series is, and about one sample in `slices` is read twice. A sample is one row that tells and one that asks, a window
    later; both are sorted once, so that a slice costs its rows, however many of them a window holds. Of oldest samples at one time that of the smallest value
    counts. A sample without a time has no window: its oldest, rate and seconds_left are null.
    """
    at, window = F.unix_micros(F.col(ts).cast("timestamp")), seconds * 1_000_000
    named = samples.select(F.struct(*(F.col(f"`{c}`") for c in samples.columns)).alias("row"), at.alias("at"), F.col(value).alias("value"), (F.col(by) if by else F.lit(0)).alias("series"))
    length = window * slices
    own, after = (F.expr(f"({x} - pmod({x}, {length})) div {length}") for x in ("at", f"(at + {window})"))
    # a sample without a time is alone in its window
    alone = F.when(F.col("at").isNull(), F.monotonically_increasing_id())
    told = F.struct(F.col("at").alias("first_at"), F.col("value").alias("first_value"))
    cell = lambda slice_, key, told_, row: F.struct(slice_.alias("slice"), key.alias("key"), told_.alias("told"), row.alias("row"))
    nothing = lambda of: F.when(F.lit(False), of)
    tells = F.transform(F.array_distinct(F.array("own", "after")), lambda x: cell(x, F.col("at"), told, nothing(F.col("row"))))
    asks = F.array(cell(F.col("own"), F.col("at") - window, nothing(told), F.col("row")))
    cells = named.withColumns({"own": own, "after": after, "alone": alone}).select("series", "alone", "at", "value", F.explode(F.concat(tells, asks)).alias("c")).select("series", "alone", "at", "value", "c.*")
    # backwards in time, so that the frame only grows: what was told last before a question is the oldest sample of its window
    x = cells.selectExpr("*", "last(told, true) over (partition by series, slice, alone order by key desc, told is null, value desc rows unbounded preceding) as oldest_of")
    x = x.where("row is not null").select("row", "at", "value", "oldest_of.*")
    span = (F.col("at") - F.col("first_at")) / 1e6
    rate = F.when(span > 0, (F.col("oldest") - F.col("value")) / span)
    x = x.withColumn("oldest", F.when(F.col("at").isNotNull(), F.col("first_value"))).withColumn("rate", rate)
    left = F.when(F.col("rate") > 0, F.col("value") * span / (F.col("oldest") - F.col("value")))
    return x.withColumn("seconds_left", left).select("row.*", "oldest", span.alias("span"), "rate", "seconds_left")


def attribute_counts(rows: DataFrame, column: str) -> DataFrame:
    """(attribute, n) of comma-separated lists; names trimmed, empty ones left out."""
    return rows.select(F.explode(F.split(column, ",")).alias("attribute")).select(F.trim("attribute").alias("attribute")).where("attribute <> ''").groupBy("attribute").agg(F.count("*").alias("n"))


def attribute_union(rows: DataFrame, attributes: str, share: float = 1.0, seed: int = 1) -> DataFrame:
    """(attribute): distinct keys of a map column, from a sample of the rows if share is below 1."""
    sampled = rows if share >= 1 else rows.sample(share, seed)
    return sampled.select(F.explode(F.map_keys(attributes)).alias("attribute")).distinct()


def merge_counters(*frames: DataFrame) -> DataFrame:
    """(counter, n): sums over frames of (counter, n)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.groupBy("counter").agg(F.sum("n").alias("n"))


# Queries

FORMATS = ["html-microdata", "html-rdfa", "html-mf-hcard", "rdf-jsonld"]


def _page_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics rows of pages, from events: some have no statements, some head metadata alone, one counter is null at times."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = F.col("event_id")
    counts = [(n % 5), (n % 3) * 2, F.when(n % 7 == 0, None).otherwise(n % 4), F.when(n % 2 == 0, n % 11).otherwise(0)]
    c = e.select(F.concat(F.lit("http://h"), (F.col("user_id") % 50).cast("string"), F.lit(".example.org/p"), n.cast("string")).alias("uri"), (n % 2).alias("html_head_meta"), *(x.alias(f) for x, f in zip(counts, FORMATS)))
    total = sum((F.coalesce(F.col(f"`{f}`"), F.lit(0)) for f in FORMATS), F.col("html_head_meta"))
    return c.withColumn("total_triples", total)


def format_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = format_profile(long_profile(_page_stats(spark, sf_dir), FORMATS))
    return p.withColumn("triples_per_url", F.round("triples_per_url", 6)).withColumn("triples_per_domain", F.round("triples_per_domain", 6))


def format_top_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_per(long_profile(_page_stats(spark, sf_dir), FORMATS), "format", "domain", F.col("triples"), 5)


def topk_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/events.parquet"), "user_id", F.lit(1), 100)


def topk_by_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of all events, from sketches of each day that are written, read and merged."""
    e, path = spark.read.parquet(f"{sf_dir}/events.parquet"), scratch_path(spark, "sketches")
    hitter_sketches(e.withColumn("day", F.to_date("ts")), "user_id", ["day"], 50_000).write.parquet(path)
    return sketched_hitters(merged_sketches(spark.read.parquet(path), tracked=50_000), "user_id", 100, tracked=50_000)


def desc_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = describe(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), "l_quantity", ["l_returnflag"])
    return d.withColumn("mean", F.round("mean", 6))


def crawl_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    k = F.col("o_orderkey")
    stats = o.select((k % 100).alias("pages_total"), (k % 90).alias("pages_parsed"), (k % 40).alias("pages_triples"), (k * 3).alias("size"), (k % 1000).alias("duration"), F.when(k % 10 == 0, float("nan")).when(k % 11 == 0, float("inf")).otherwise((k % 64).cast("double")).alias("rate"))
    t = job_totals(stats)
    return t.withColumn("mean_rate", F.round("mean_rate", 6)).withColumn("cpu_minutes", F.round("cpu_minutes", 6))


def path_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = F.concat(F.regexp_extract("url", r"^https?://([^/?#]+)", 1), F.regexp_extract("url", r"^https?://[^/?#]+([^?#]*)", 1))
    return path_rollup(p.select(path.alias("path"), F.octet_length("html").cast("long").alias("size")), "path", "size")


def queue_rate_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", (F.lit(100_000) - F.col("event_id")).alias("left"))
    s = rate_window(e.withColumn("queue", F.col("user_id") % 8), "ts", "left", "queue")
    return s.select("event_id", "oldest", F.round("rate", 6).alias("rate"), F.round("seconds_left", 3).alias("seconds_left"))


def queue_rate_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as one series."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", (F.lit(100_000) - F.col("event_id")).alias("left"))
    s = rate_window(e, "ts", "left", seconds=600)
    return s.select("event_id", "oldest", F.round("rate", 6).alias("rate"), F.floor("seconds_left").cast("double").alias("seconds_left"))


def attribute_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    return attribute_counts(p.select(F.concat_ws(",", F.col("p_brand"), F.lit(" "), F.concat(F.lit(" "), "p_type"), F.col("p_brand")).alias("a")), "a")


def corpus_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").agg(F.count("*").alias("n"))


def url_span_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.sum(F.octet_length("props").cast("long")).alias("bytes"))


QUERIES = {f.__name__: f for f in (format_profiles, format_top_domains, topk_exact, topk_by_sketch, desc_stats, crawl_totals, path_rollups, queue_rate_window, queue_rate_series, attribute_count, corpus_count, url_span_totals)}
_STATS = """s as (select 'http://h' || (user_id % 50) || '.example.org/p' || event_id as uri, 'h' || (user_id % 50) || '.example.org' as domain, event_id % 2 as m,
        event_id % 5 as a, (event_id % 3) * 2 as b, case when event_id % 7 = 0 then 0 else event_id % 4 end as c, case when event_id % 2 = 0 then event_id % 11 else 0 end as d from events),
    x as (select uri, domain, f as format, t as triples from (
        select uri, domain, 'html-microdata' as f, a as t from s union all select uri, domain, 'html-rdfa', b from s
        union all select uri, domain, 'html-mf-hcard', c from s union all select uri, domain, 'rdf-jsonld', d from s) where t >= 1)"""
ORACLE_SQL = {
    "format_profiles": f"""with {_STATS} select format, sum(triples)::bigint as triples, count(*) as urls, count(distinct domain) as domains,
        round(sum(triples) / count(*), 6) as triples_per_url, round(sum(triples) / count(distinct domain), 6) as triples_per_domain from x group by 1""",
    "format_top_domains": f"""with {_STATS}, n as (select format, domain, sum(triples)::bigint as n from x group by 1, 2)
        select * from (select *, (row_number() over (partition by format order by n desc, domain))::int as place from n) where place <= 5""",
    "topk_exact": "select user_id, count(*) as n from events group by 1 order by n desc, user_id limit 100",
    "topk_by_sketch": "select user_id, count(*) as n from events group by 1 order by n desc, user_id limit 100",
    "desc_stats": "select l_returnflag, min(l_quantity) as min, max(l_quantity) as max, round(avg(l_quantity), 6) as mean, median(l_quantity) as median, count(l_quantity) as n from lineitem group by 1",
    "crawl_totals": """select sum(o_orderkey % 100)::bigint as pages_total, sum(o_orderkey % 90)::bigint as pages_parsed, sum(o_orderkey % 40)::bigint as pages_triples, sum(o_orderkey * 3)::bigint as size,
        round(avg(o_orderkey % 64) filter (o_orderkey % 10 <> 0 and o_orderkey % 11 <> 0), 6) as mean_rate, round(sum(o_orderkey % 1000) / 60000.0, 6) as cpu_minutes from orders""",
    "path_rollups": r"""with p as (select str_split(regexp_extract(url, '^https?://([^/?#]+)', 1) || regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), '/') as parts, strlen(html) as size from pages),
        x as (select array_to_string(parts[1:n], '/') as prefix, size from p, unnest(range(1, len(parts) + 1)) r(n))
        select prefix, count(*) as files, sum(size)::bigint as bytes from x group by 1""",
    "queue_rate_window": """with e as (select event_id, epoch_us(ts) as t, user_id % 8 as queue, 100000 - event_id as v from events),
        w as (select *, first_value(v) over f as a, min(t) over f as t0 from (select event_id, t, queue, v from e)
              window f as (partition by queue order by t range between 120000000 preceding and current row))
        select event_id, oldest, round((oldest - v) / nullif(t - t0, 0) * 1e6, 6) as rate, round(case when oldest > v and t > t0 then v * ((t - t0) / 1e6) / (oldest - v) end, 3) as seconds_left
        from (select w.*, (select min(e.v) from e where e.queue = w.queue and e.t = w.t0) as oldest from w)""",
    "queue_rate_series": """with e as (select event_id, epoch_us(ts) as t, 100000 - event_id as v from events),
        w as (select *, min(t) over (order by t range between 600000000 preceding and current row) as t0 from e),
        o as (select t as t0, min(v) as oldest from e group by t)
        select event_id, oldest, round((oldest - v) / nullif(t - t0, 0) * 1e6, 6) as rate, floor(case when oldest > v and t > t0 then v * ((t - t0) / 1e6) / (oldest - v) end)::double as seconds_left from w join o using (t0)""",
    "attribute_count": "select attribute, count(*) as n from (select p_brand as attribute from part union all select p_type from part union all select p_brand from part) group by 1",
    "corpus_count": "select count(*) as n from documents",
    "url_span_totals": "select min(ts) as first, max(ts) as last, sum(strlen(props))::bigint as bytes from events",
}
