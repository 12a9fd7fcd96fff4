"""Whole jobs from archives to results, and a place for jobs of one's own.

A job is a function of (spark, source, out): it reads a path, writes tables below `out`, and returns the
names of what it wrote. All of them run as Spark jobs from end to end; damaged records end up in a table
`failures` and never stop a job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcrawl.operators import links, relations, structured_data, web_tables
from loomcrawl.operators.scratch import saved
from loomcrawl.sources import archives, sinks, text

Job = Callable[[SparkSession, str, str], list[str]]
JOBS: dict[str, Job] = {}


def job(name: str) -> Callable[[Job], Job]:
    """Registers a job under a name; an existing one is replaced."""

    def add(f: Job) -> Job:
        JOBS[name] = f
        return f

    return add


def run(name: str, spark: SparkSession, source: str, out: str) -> list[str]:
    return JOBS[name](spark, source, out)


def iterate(rows: DataFrame, process: Callable[[pd.DataFrame], pd.DataFrame], schema: str, finish: Callable[[], pd.DataFrame] | None = None) -> DataFrame:
    """process() over batches of rows, and finish() once per task after its last batch, for code that no column expression replaces.

    Both return rows of the schema given. Tasks share nothing: combine what they return with an aggregate.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield process(b)
        if finish is not None:
            yield finish()

    return rows.mapInPandas(run, schema)


def _pages(spark: SparkSession, source: str, out: str) -> DataFrame:
    """HTML responses of WARC archives; what could not be read is written to `failures`."""
    archives.register(spark)
    records = spark.read.format("warc").load(source)
    archives.rejected_records(records).write.mode("overwrite").parquet(f"{out}/failures")
    return archives.html_responses(records)


@job("structured-data")
def structured_data_job(spark: SparkSession, source: str, out: str) -> list[str]:
    """Quads by extractor, statistics by page, and totals by extractor."""
    pages = saved(_pages(spark, source, out), "pages")
    quads = saved(structured_data.extract_quads(pages, "html", "uri"), "quads")
    sinks.write_by_extractor(quads, f"{out}/quads")
    stats = structured_data.page_statistics(pages, quads, "uri")
    stats.write.mode("overwrite").parquet(f"{out}/page_stats")
    quads.groupBy("extractor").agg(F.count("*").alias("triples"), F.countDistinct("graph").alias("urls")).write.mode("overwrite").parquet(f"{out}/totals")
    return ["failures", "quads", "page_stats", "totals"]


@job("links")
def link_job(spark: SparkSession, source: str, out: str) -> list[str]:
    """Clean adjacency, node index and integer edges from crawl metadata, and its redirects."""
    records = saved(text.wat(spark, source), "wat")
    links.wat_redirects(records).select("uri", "status").write.mode("overwrite").parquet(f"{out}/redirects")
    clean = saved(links.clean_links(links.wat_adjacency(records)), "adjacency")
    edges = links.edges(clean)
    index = saved(links.url_index(links.url_list(edges)), "index")
    index.write.mode("overwrite").parquet(f"{out}/index")
    links.distinct_edges(links.index_edges(edges, index)).write.mode("overwrite").parquet(f"{out}/edges")
    return ["redirects", "index", "edges"]


@job("tables")
def table_job(spark: SparkSession, source: str, out: str) -> list[str]:
    """Relational tables of pages without their copies, as JSON lines, and how many were rejected why."""
    tables = saved(web_tables.extract_tables(_pages(spark, source, out), "html", "uri"), "tables")
    web_tables.rejection_counters(tables).write.mode("overwrite").parquet(f"{out}/counters")
    found = web_tables.relations(tables).select(
        "relation", F.col("page_title").alias("pageTitle"), "title", "url", (F.col("header_row") >= 0).alias("hasHeader"), F.col("header_position").alias("headerPosition"), F.col("table_no").alias("tableNum"),
        F.col("orientation").alias("tableOrientation"), F.col("before").alias("textBeforeTable"), F.col("after").alias("textAfterTable"), (F.col("key_column") >= 0).alias("hasKeyColumn"), F.col("key_column").alias("keyColumnIndex"), F.col("header_row").alias("headerRowIndex"),
    ).withColumn("order", F.concat_ws(" ", "url", F.format_string("%09d", "tableNum")))
    relations.dedup_tables(found, "order").drop("order").write.mode("overwrite").option("compression", "gzip").json(f"{out}/tables")
    return ["failures", "counters", "tables"]


def lookup_job(spark: SparkSession, source: str, classes: str, out: str) -> list[str]:
    """Pages whose URL a map of classes has, with their class; the map is TAB-separated text."""
    pages = _pages(spark, source, out).withColumnRenamed("uri", "url")
    found = relations.label_lookup(pages, text.url_classes(spark, classes), "url")
    sinks.write_labelled_pages(found.select(F.col("url").alias("uri"), "content_type", "class", F.col("html").alias("content")), f"{out}/labelled")
    return ["failures", "labelled"]
