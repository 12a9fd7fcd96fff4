"""Outputs: statements, statistics, tables, indexes, reports and text dumps. All are written by the executors."""

from __future__ import annotations

import html as entities
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcrawl.operators.postings import write_postings
from loomcrawl.operators.quads import format_quads, write_by_extractor
from loomcrawl.operators.ranks import dense_ids
from loomcrawl.operators.relations import row_terms, write_datasets


def write_nquads(quads: DataFrame, path: str) -> None:
    """gzip text, the extractor as fifth term."""
    format_quads(quads).write.option("compression", "gzip").text(path)


def write_csv(rows: DataFrame, path: str) -> None:
    """gzip CSV with a header, columns by name."""
    rows.select(*(F.col(f"`{c}`") for c in sorted(rows.columns))).write.csv(path, header=True, compression="gzip", quote='"', escape='"')


def write_adjacency(adjacency: DataFrame, path: str) -> None:
    """gzip lines `origin TAB target TAB …`."""
    adjacency.select(F.concat_ws("\t", "origin", "links").alias("value")).write.option("compression", "gzip").text(path)


def write_edges(edges: DataFrame, path: str) -> None:
    edges.write.csv(path, sep="\t", compression="gzip")


def write_text_index(tables: DataFrame, path: str, doc_id: str, fields: dict) -> None:
    """An inverted index as posting blocks below path/field=NAME, see operators.postings; doc_id is a number."""
    write_postings(row_terms(tables, doc_id, fields), path, doc_id)


def write_key_value(rows: DataFrame, path: str, key: str) -> None:
    """(key, json) as Parquet, sorted by key in ranges: a lookup reads one row group."""
    out = rows.select(F.col(key).cast("long").alias("key"), F.to_json(F.struct("*")).alias("json"))
    out.repartitionByRange("key").sortWithinPartitions("key").write.parquet(path)


def read_key_value(spark, path: str, keys: list[int]) -> DataFrame:
    return spark.read.parquet(path).where(F.col("key").isin(*keys))


def write_labelled_pages(pages: DataFrame, path: str) -> None:
    """Pages with their class as gzip JSON lines: uri, content_type, class, content."""
    pages.select("uri", "content_type", "class", "content").write.option("compression", "gzip").json(path)


def write_record_dump(records: DataFrame, path: str, rows_per_file: int = 1000) -> None:
    """Column text as files of at most rows_per_file records."""
    records.select(F.concat(F.col("text"), F.lit("\n")).alias("value")).write.option("maxRecordsPerFile", rows_per_file).text(path)


#: Rows of a table in a report; longer tables are cut there and say so.
REPORT_ROWS = 1000


def report(tables: dict[str, DataFrame], rows: int = REPORT_ROWS) -> tuple[str, str]:
    """(json, html) of small result tables; a table of more rows is shown to its first ones in its own order."""
    data = {name: [r.asDict(recursive=True) for r in t.limit(rows + 1).collect()] for name, t in tables.items()}
    parts = []
    for name, found in data.items():
        shown, columns = found[:rows], tables[name].columns
        cell = lambda v: f"<td>{entities.escape('' if v is None else str(v))}</td>"
        body = "".join(f"<tr>{''.join(cell(r[c]) for c in columns)}</tr>" for r in shown)
        more = "<p>More rows are not shown.</p>" if len(found) > rows else ""
        parts.append(f"<h2>{entities.escape(name)}</h2><table><tr>{''.join(f'<th>{entities.escape(c)}</th>' for c in columns)}</tr>{body}</table>{more}")
    return json.dumps({n: x[:rows] for n, x in data.items()}, default=str, ensure_ascii=False, indent=1), f"<!DOCTYPE html><meta charset=utf-8><title>Report</title>{''.join(parts)}"


def write_report_pages(table: DataFrame, path: str, order: list[str], rows: int = REPORT_ROWS) -> None:
    """A table of any length as HTML files below path/page=N, of `rows` rows each in the order given, with links to the pages around.

    Rows are numbered by a range sort, a page is an aggregate of its rows, and executors write all pages.
    """
    text = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    cell = lambda c: F.concat(F.lit("<td>"), text(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))), F.lit("</td>"))
    lines = table.select(*(F.col(c).alias(f"_by{k}") for k, c in enumerate(order)), F.concat(F.lit("<tr>"), *map(cell, table.columns), F.lit("</tr>")).alias("row"))
    placed = dense_ids(lines, [f"_by{k}" for k in range(len(order))], "place", "report").withColumn("page", F.expr(f"place div {rows}"))
    pages = placed.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("place", "row"))).alias("rows"), F.count("*").alias("n"))
    head = "".join(f"<th>{entities.escape(c)}</th>" for c in table.columns)
    link = lambda page, name: F.concat(F.lit("<a href='../page="), page.cast("string"), F.lit(f"/'>{name}</a> "))
    around = F.concat(F.when(F.col("page") > 0, link(F.col("page") - 1, "before")).otherwise(""), F.when(F.col("n") == rows, link(F.col("page") + 1, "after")).otherwise(""))
    html = F.concat(F.lit("<!DOCTYPE html><meta charset=utf-8><title>Report</title>"), around, F.lit(f"<table><tr>{head}</tr>"), F.array_join(F.col("rows.row"), ""), F.lit("</table>"))
    pages.select("page", html.alias("value")).write.partitionBy("page").text(path)


__all__ = ["write_nquads", "write_csv", "write_adjacency", "write_edges", "write_text_index", "write_key_value", "read_key_value", "write_labelled_pages", "write_record_dump", "report", "write_report_pages", "write_by_extractor", "write_datasets"]
