"""Exact dedup by two-pass Bloom filtering, in DataFrame and SQL functions only.

Pass 1 hashes every text and counts how often each bit of a blocked Bloom filter is hit; bits hit
twice or more form the filter of possibly repeated hashes, kept as one bitmap per block. Pass 2
probes it: rows with a bit that is not set cannot have a copy and pass straight through; only the
others are grouped by their SHA-256. The filter never misses a copy; a false hit costs one grouped
row and changes no result.

What is probed and grouped are digests with the number of their row, some 50 bytes each, at every size;
texts are never shuffled. Spark broadcasts the filter where it is small and joins digests with it by
block beyond that. Rows that go are named by number, fewer than there are copies.

Texts are equal when identical after lower-casing A-Z. A null text counts as empty. The row with
the largest doc_id of equal texts stays; of rows that also share that doc_id exactly one stays. A
null doc_id is below all others. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, bit, numbered, saved, without

#: Bits of a block, as bitmap_construct_agg has them.
BLOCK_BITS = 32768
#: Two bits a row in 32 bits a row: about one row in 250 that has no copy is grouped in vain.
BITS_PER_ROW = 32


def text_digest(text: Column) -> Column:
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256)


def _places(sha: Column, blocks: int) -> list[Column]:
    """Block and the two bits in it of a digest."""
    h = F.xxhash64(sha, F.lit(2))
    return [F.pmod(F.xxhash64(sha), F.lit(blocks)).alias("block"), h.bitwiseAND(BLOCK_BITS - 1).alias("bit1"), F.shiftrightunsigned(h, 20).bitwiseAND(BLOCK_BITS - 1).alias("bit2")]


def repeat_filter(digests: DataFrame) -> tuple[DataFrame, int]:
    """(block, bits) of the possibly repeated values of column sha, and the number of blocks."""
    blocks = max(1, -(-digests.count() * BITS_PER_ROW // BLOCK_BITS))
    hits = digests.select(*_places(F.col("sha"), blocks)).select("block", F.explode(F.array("bit1", "bit2")).alias("bit"))
    twice = hits.groupBy("block", "bit").agg(F.count("*").alias("n")).where("n > 1")
    return saved(twice.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")), "repeat-filter"), blocks


def with_maybe(df: DataFrame, sha: str, filt: tuple[DataFrame, int], out: str) -> DataFrame:
    """df with a boolean column: false where the digest in `sha` surely occurs once.

    Spark broadcasts the filter where its written size is under autoBroadcastJoinThreshold, and
    joins by block beyond it.
    """
    bits, blocks = filt
    block, bit1, bit2 = _places(F.col(sha), blocks)
    cols = df.columns
    probe = df.withColumns({"_block": block, "_bit1": bit1, "_bit2": bit2})
    found = probe.join(bits.select(F.col("block").alias("_block"), F.col("bits").alias("_bits")), "_block", "left")
    return found.select(*(F.col(f"`{c}`") for c in cols), F.coalesce((bit(F.col("_bits"), F.col("_bit1")) + bit(F.col("_bits"), F.col("_bit2"))) == 2, F.lit(False)).alias(out))


def _digests(docs: DataFrame, text: str, doc_id: str, *more: str) -> DataFrame:
    """(row, doc_id, sha, maybe) of each row of docs, and the columns `more`; maybe: false where the text surely occurs once."""
    columns = [F.col(c) if c == "row" else F.monotonically_increasing_id().alias("row") for c in (more or ("",))]
    digests = saved(docs.select(*columns, F.col(doc_id).alias("doc_id"), text_digest(F.col(text)).alias("sha")), "digests")
    return with_maybe(digests, "sha", repeat_filter(digests), "maybe")


def _staying(maybe: DataFrame) -> DataFrame:
    """(sha, stays (doc_id, row), group_size) of the texts of maybe (sha, doc_id, row)."""
    return saved(maybe.groupBy("sha").agg(F.max(F.struct("doc_id", "row")).alias("stays"), F.count("*").alias("group_size")), "groups")


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    flagged = _digests(docs, text, doc_id)
    once = flagged.where("not maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    maybe = flagged.where("maybe")
    many = maybe.join(_staying(maybe), "sha").select("doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("stays.row")).alias("kept"), F.col("sha").alias("text_sha256"))
    return once.unionByName(many)


def drop_exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of docs that stay, with all their columns, whatever these are."""
    rows = numbered(docs, "numbered")
    body = rows.select("row", F.col("kept_row").getField(doc_id).alias("doc_id"), F.col("kept_row").getField(text).alias("text"))
    maybe = _digests(body, "text", "doc_id", "row").where("maybe")
    groups = _staying(maybe).where("group_size > 1").withColumnRenamed("sha", "of")
    return without(rows, saved(maybe.join(groups, F.col("sha") == F.col("of")).where("row <> stays.row").select("row"), "gone"))
