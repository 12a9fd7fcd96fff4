"""Sharding along a Hilbert curve over several metadata dimensions.

Every dimension is quantised at quantiles taken over all rows; a row's cells are coordinates of a
Hilbert curve, and rows are cut into shards along it. Neighbours on the curve are neighbours in every
dimension, so a shard's files span a small range of each one, and readers that filter by any of them
skip most files by their min/max statistics.

Strings are told apart whole, by their rank among the distinct values. Law `rows`: shard sizes differ by
one row at most, and slots are gapless from 0 in curve order. Equal texts lie where their metadata put
them: apart where their languages or sources differ, and a cut may part neighbours. Ranks come from a
range sort of narrow rows; texts are not moved to assign shards.

A null dimension is a cell value below all others; a null text has 0 bytes (size 1) and CRC 0. A null
doc_id sorts first; rows that share one each get a slot. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import dense_index, numbered, saved


@dataclass(frozen=True)
class ShardParams:
    shards: int = 16
    #: Bits per dimension.
    bits: int = 4
    #: Accuracy of the quantiles, as percentile_approx takes it.
    accuracy: int = 10_000


def default_dimensions() -> dict[str, Column]:
    return {"lang": F.col("lang"), "source": F.col("source"), "size": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")}


def hilbert_index(coords: list[np.ndarray], bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with coordinates from 0 to 2^bits - 1, by Skilling's transform."""
    x = [c.astype(np.int64).copy() for c in coords]
    for q in (1 << k for k in range(bits - 1, 0, -1)):
        for i in range(len(x)):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(on, q - 1, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for q in (1 << k for k in range(bits - 1, 0, -1)):
        flip ^= np.where(x[-1] & q, q - 1, 0)
    out = np.zeros_like(x[0])
    for k in range(bits - 1, -1, -1):
        for c in x:
            out = out << 1 | ((c ^ flip) >> k & 1)
    return out


def quantile_cuts(df: DataFrame, dims: list[str], params: ShardParams) -> dict[str, list[int]]:
    """Cut points of each long column, from all rows: 2^bits - 1 numbers a dimension at most."""
    shares = [k / (1 << params.bits) for k in range(1, 1 << params.bits)]
    row = df.agg(*(F.percentile_approx(d, shares, params.accuracy).alias(d) for d in dims)).first()
    return {d: sorted(set(row[d] or [])) for d in dims}


def curve(cuts: dict[str, list[int]], dims: list[Column], bits: int) -> Column:
    tables = [np.array(c, np.int64) for c in cuts.values()]

    @F.arrow_udf("long")
    def place(*values: pa.Array) -> pa.Array:
        return pa.array(hilbert_index([np.searchsorted(t, v.to_numpy(zero_copy_only=False)) for t, v in zip(tables, values)], bits))

    return place(*dims)


def _columns(docs: DataFrame, dims: dict[str, Column], doc_id: str, text: str) -> dict[str, Column]:
    """What is needed of a row to place it: doc_id, size, text_crc32 and a column per dimension, a long or a string."""
    body = F.coalesce(F.col(text), F.lit(""))
    kinds = {f.name: f.dataType for f in docs.select(*(c.alias(f"dim_{k}") for k, c in enumerate(dims.values()))).schema}
    of = {f"dim_{k}": c.cast("string" if isinstance(kinds[f"dim_{k}"], StringType) else "long") for k, c in enumerate(dims.values())}
    return {"doc_id": F.col(doc_id).cast("long"), "size": (F.octet_length(body) + 1).cast("long"), "text_crc32": F.crc32(body.cast("binary")), **of}


def string_ranks(narrow: DataFrame) -> dict[str, DataFrame]:
    """For each dimension that is a string: (of, rank), its distinct whole values by code point; null has none."""
    names = [f.name for f in narrow.schema if f.name.startswith("dim_") and isinstance(f.dataType, StringType)]
    return {n: saved(dense_index(narrow.where(F.col(n).isNotNull()).select(F.col(n).alias("of")).distinct(), [F.col("of")], "shard-values", "rank"), "shard-ranks") for n in names}


def _with_ranks(rows: DataFrame, ranks: dict[str, DataFrame]) -> DataFrame:
    """rows with strings as ranks; Spark sends the ranks where they are few and joins by value beyond that."""
    for name, of in ranks.items():
        joined = rows.join(of, rows[name] == of["of"], "left")
        rows = joined.select(*(F.col("rank").alias(c) if c == name else F.col(c) for c in rows.columns))
    return rows


def _placed(rows: DataFrame, ranks: dict[str, DataFrame], cuts: dict[str, list[int]], bits: int) -> DataFrame:
    dims = [F.coalesce(F.col(n), F.lit(-1).cast("long")) for n in cuts]
    return _with_ranks(rows, ranks).withColumn("place", curve(cuts, dims, bits)).drop(*cuts)


def _assigned(narrow: DataFrame, params: ShardParams) -> tuple[DataFrame, dict[str, DataFrame], dict[str, list[int]]]:
    """narrow with place, shard and slot; and the ranks and cuts that place other columns of the same rows alike."""
    ranks = string_ranks(narrow)
    cuts = quantile_cuts(_with_ranks(narrow, ranks), [c for c in narrow.columns if c.startswith("dim_")], params)
    ranked = dense_index(_placed(narrow, ranks, cuts, params.bits), [F.col(c) for c in ORDER], "shard-places", "rank")
    n = max(1, narrow.count())
    shards = ranked.withColumn("shard", F.expr(f"cast(rank * {params.shards} div {n} as int)"))
    return shards.withColumn("slot", F.expr(f"rank - (cast(shard as bigint) * {n} + {params.shards - 1}) div {params.shards}")).drop("rank"), ranks, cuts


#: Rows along the curve; the row's number parts rows that are equal in all else.
ORDER = ["place", "doc_id", "text_crc32", "row"]


def hilbert_shards(docs: DataFrame, params: ShardParams = ShardParams(), dims: dict[str, Column] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, place (on the curve), shard, slot."""
    columns = _columns(docs, dims or default_dimensions(), doc_id, text)
    narrow = saved(docs.select(F.monotonically_increasing_id().alias("row"), *(c.alias(n) for n, c in columns.items())), "shard-sizes")
    return _assigned(narrow, params)[0].drop("row")


def write_shards(docs: DataFrame, path: str, params: ShardParams = ShardParams(), dims: dict[str, Column] | None = None, doc_id: str = "doc_id", text: str = "text") -> None:
    """docs as Parquet below path/shard=K, each file a run of the curve; a column `shard` of docs gives way to it.

    Rows find their shard by the first row of each, in the one order of all rows. Texts are moved once.
    """
    rows = numbered(docs, "shard-rows", _columns(docs, dims or default_dimensions(), doc_id, text))
    shards, ranks, cuts = _assigned(rows.drop("kept_row", "block"), params)
    key = F.struct(*ORDER)
    firsts = shards.groupBy("shard").agg(F.min(key).alias("k")).orderBy("shard").collect()  # one row per shard
    bound = lambda k: F.struct(*(F.lit(v).cast("long").alias(n) for n, v in zip(ORDER, k)))
    shard = F.lit(-1)
    for first in firsts[::-1]:
        shard = F.when(key >= bound(first.k), F.lit(first.shard)) if first is firsts[-1] else shard.when(key >= bound(first.k), F.lit(first.shard))
    out = _placed(rows, ranks, cuts, params.bits).withColumn("_shard", shard).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    kept = [F.col("kept_row").getField(c).alias(c) for c in docs.columns if c != "shard"]
    out.select(*kept, F.col("_shard").alias("shard")).write.partitionBy("shard").parquet(path)


def shard_report(docs: DataFrame, params: ShardParams = ShardParams()) -> DataFrame:
    return hilbert_shards(docs, params).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "place")
