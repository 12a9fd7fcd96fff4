"""Text inputs: crawl metadata, statements, table corpora, maps and lists."""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcrawl.operators.links import WAT_SCHEMA, parse_adjacency, wat_records
from loomcrawl.operators.quads import parse_quads
from loomcrawl.operators.ranks import dense_ids
from loomcrawl.operators.relations import read_datasets
from loomcrawl.sources.staged import open_path


def wat(spark: SparkSession, path: str) -> DataFrame:
    """Envelopes of crawl metadata; of each file's lines those that begin with a brace."""
    return wat_records(spark.read.text(path))


def redirects(spark: SparkSession, path: str) -> DataFrame:
    """Envelopes from lines `"uri","json"` with doubled quotes, and the uri as `source`."""
    rows = spark.read.csv(path, schema="source string, value string", quote='"', escape='"')
    return wat_records(rows)


def nquads(spark: SparkSession, path: str) -> DataFrame:
    return parse_quads(spark.read.text(path))


def nquads_series(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All statements of several files or globs, in one table."""
    return reduce(DataFrame.unionByName, (nquads(spark, p) for p in paths))


def csv_lines(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """CSV whose quoted fields never span lines, so files are split."""
    return spark.read.csv(path, header=header, multiLine=False, quote='"', escape='"', mode="PERMISSIVE")


#: Lines of a file that cross to the JVM at once.
LINES = 5000


def _gz_pieces(file: str) -> Iterator[tuple[list[bytes], str | None]]:
    """A file's lines, LINES at most at once; what stops that comes last, with the lines before it."""
    values: list[bytes] = []
    try:
        system, where = open_path(file)
        with system.open_input_stream(where, compression=None) as raw, gzip.GzipFile(fileobj=raw) as lines:
            for line in lines:
                values.append(line.rstrip(b"\r\n"))
                if len(values) == LINES:
                    yield values, None
                    values = []
        if values:
            yield values, None
    except (OSError, EOFError, zlib.error) as e:
        yield values, f"{type(e).__name__}: {e}"[:200]


def _dealt_files(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """(path): by number, as names are too small for Spark to see the files behind them."""
    files = listing(spark, path, suffix).select("path")
    return files.repartition(max(1, min(files.count(), 100_000)), "path")


def gz_lines(spark: SparkSession, path: str, suffix: str = ".gz") -> DataFrame:
    """(file, value, error): the lines of all files below a path that end so, each file read by one task.

    What can be read of a damaged file is kept; then comes a row with the error and no value, and the other files go on. An
    empty file is not listed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file in b.column(0).to_pylist():
                for values, error in _gz_pieces(file):
                    told = pa.array([v.decode("utf-8", "replace") for v in values] + [None] * (error is not None), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([file] * len(told), pa.string()), told, pa.array([None] * len(values) + [error] * (error is not None), pa.string())], ["file", "value", "error"])

    return _dealt_files(spark, path, suffix).mapInArrow(run, "file string, value string, error string")


def table_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Tables of all *.gz files below a path; lines that are no tables have a null dataset. What damaged files have is kept, see corpus_files."""
    return read_datasets(gz_lines(spark, path).where("error is null").select("value"))


def corpus_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, lines, error): a row for each file of a corpus that is not empty, with the lines that could be read and what stopped that, if anything did."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file in b.column(0).to_pylist():
                # counted where they are read: grouped, the lines of a file would be sorted in a task
                lines, error = 0, None
                for values, error in _gz_pieces(file):
                    lines += len(values)
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([lines], pa.int64()), pa.array([error], pa.string())], ["file", "lines", "error"])

    return _dealt_files(spark, path, ".gz").mapInArrow(run, "file string, lines long, error string")


def url_classes(spark: SparkSession, path: str) -> DataFrame:
    """(url, class) of a TAB-separated map."""
    return spark.read.csv(path, sep="\t", schema="url string, class string")


def segments(spark: SparkSession, path: str) -> DataFrame:
    """(place, segment): distinct names of a list, one a line, blank ones left out, numbered from 0 in the order of their first line (of several files: by path)."""
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(path).select(at.alias("at"), F.trim("value").alias("segment")).where("segment <> ''")
    first = lines.groupBy("segment").agg(F.min("at").alias("at"))
    return dense_ids(first.select("at.file", "at.start", "at.line", "segment"), ["file", "start", "line"], "place", "segments").select("place", "segment")


def adjacency(spark: SparkSession, path: str) -> DataFrame:
    """(origin, links) of lines `origin TAB target TAB …`; lines without a target or an origin are dropped."""
    return parse_adjacency(spark.read.text(path))


def edge_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="origin string, target string")


def index_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="url string, id bigint")


def listing(spark: SparkSession, path: str, suffix: str = "", limit: int | None = None) -> DataFrame:
    """(path, bytes, modified) of the files below a path, without reading them; at most `limit` of them, by path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(path)
    out = files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    return out if limit is None else out.orderBy("path").limit(limit)


__all__ = ["WAT_SCHEMA", "wat", "redirects", "nquads", "nquads_series", "csv_lines", "gz_lines", "table_corpus", "corpus_files", "url_classes", "segments", "adjacency", "edge_text", "index_text", "listing"]
