"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcrawl.operators.ranks import dense_ids
from loomcrawl.operators.scratch import saved as written
from loomcrawl.operators.scratch import scratch_path

__all__ = ["UPPER", "WORD", "ascii_lower", "bit", "dense_index", "n_buckets", "numbered", "numbered_texts", "saved", "scratch_path", "small_batches", "table", "without"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words are the runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of whole texts that cross to Python at once.
TEXT_ROWS = 1000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Within it, at most TEXT_ROWS rows cross to Python at once; afterwards the session is as it was."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(TEXT_ROWS, int(before)) if int(before) > 0 else TEXT_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def saved(df: DataFrame, name: str) -> DataFrame:
    """df as a written table of the shared folder, made from small batches."""
    with small_batches(df.sparkSession):
        return written(df, name)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is; pure ASCII takes Spark's faster lower()."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def dense_index(df: DataFrame, order: list[Column], name: str, out: str = "idx") -> DataFrame:
    """df with a gapless long from 0 in the given total order; `name` names the written table."""
    return dense_ids(df, order, out, name)


#: Rows of a numbered table that share a bitmap.
ROW_BLOCK = 8192


def numbered(docs: DataFrame, name: str, more: dict[str, Column] | None = None, block: int = ROW_BLOCK) -> DataFrame:
    """docs as a written table: row (a number of its own), block, kept_row (a struct of all columns), and the columns `more`.

    The table is bucketed by block, which moves nothing, as a task's rows make up blocks of their own, of
    `block` rows at most (a power of two; ROW_BLOCK where `without` is to take rows away).
    """
    row = F.monotonically_increasing_id()
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("kept_row"), *(c.alias(n) for n, c in (more or {}).items())).withColumn("row", row).withColumn("block", F.shiftright("row", block.bit_length() - 1))
    return _bucketed(whole, docs, name)


def n_buckets(df: DataFrame) -> int:
    """Parts to write df in: one per spark.sql.files.maxPartitionBytes of its size by Spark's statistics, at most spark.sql.sources.bucketing.maxBuckets; spark.sql.shuffle.partitions where these are unknown."""
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= UNKNOWN:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    at_most = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return min(max(1, -(-size // at_most)), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))


#: What statistics have for a size that is not known, and sizes that follow from it.
UNKNOWN = 1 << 60


def _bucketed(whole: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """whole, made from docs, as a table written in buckets by block, as many as the size of docs asks for."""
    spark = docs.sparkSession
    known = f"loomcrawl_{name.replace('-', '_')}_{uuid.uuid4().hex}"
    with small_batches(spark):
        whole.write.bucketBy(n_buckets(docs), "block").option("path", scratch_path(spark, name)).option("compression", "zstd").saveAsTable(known)
    rows = spark.table(known)
    spark.sql(f"drop table {known}")  # from the catalog; the files stay
    return rows


#: Bytes of texts after which a block of numbered_texts ends.
BLOCK_BYTES = 8 << 20


def numbered_texts(docs: DataFrame, name: str, columns: dict[str, Column], row_bits: int) -> DataFrame:
    """Some columns of docs as a written table, `text` among them, with row and block = row >> row_bits; bucketed by block.

    A block ends after 2^row_bits rows or BLOCK_BYTES of text, so that one can be held whole.
    """
    narrow = docs.select(*(c.alias(n) for n, c in columns.items()))
    at = narrow.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, n, held = TaskContext.get().partitionId() << 32, 0, 0
        for b in batches:
            row = []
            for size in pc.binary_length(b.column(at)).to_pylist():
                if n == 1 << row_bits or n and held + (size or 0) > BLOCK_BYTES:
                    block, n, held = block + 1, 0, 0
                row.append((block << row_bits) + n)
                n, held = n + 1, held + (size or 0)
            rows = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([rows, pc.shift_right(rows, row_bits), *b.columns], ["row", "block", *b.schema.names])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema)
    return _bucketed(narrow.mapInArrow(run, f"row long, block long, {kinds}"), docs, name)


def bit(bits: Column, at: Column) -> Column:
    """The bit of a bitmap of bitmap_construct_agg, 0 or 1; null without one."""
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return F.floor(byte / F.pow(F.lit(2), F.pmod(at, F.lit(8)))).bitwiseAND(1)


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of a numbered table but those whose number is in gone (row), with the columns of their struct.

    What is moved are bitmaps of the numbers, one per block of rows that has any: by the table's buckets, so
    that the rows themselves stay where they are read, however many go.
    """
    at = F.col("row").bitwiseAND(ROW_BLOCK - 1)
    bits = gone.groupBy(F.shiftright("row", ROW_BLOCK.bit_length() - 1).alias("block")).agg(F.bitmap_construct_agg(at).alias("bits"))
    found = rows.join(bits.hint("shuffle_hash"), "block", "left")
    return found.where(F.coalesce(bit(F.col("bits"), at), F.lit(0)) == 0).select("kept_row.*")
