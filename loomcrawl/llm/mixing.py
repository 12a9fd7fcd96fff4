"""Mixing sources to target weights, in DataFrame and SQL functions only.

Sizes are summed per source, each source gets a target and so a repetition rate, and every document
is emitted floor(rate) times plus one more with probability equal to the fraction. That draw is a
hash of the document's id and a seed: reruns agree, whatever the partitioning is.

A null text has size 0. A null source is a source of its own, after all others. A source of size 0
gets target 0 and its documents are not emitted. Rows that share a doc_id share their draw. A null
doc_id draws as the empty string. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, dense_index, saved

#: A draw has 52 bits: the first 13 hex digits of an MD5.
DRAW = 2.0**52


@dataclass(frozen=True)
class MixParams:
    #: Weights of the sources by rank, repeated.
    weights: tuple[int, ...] = (1, 2, 3)
    #: No source's target exceeds its size times this.
    most: int = 3
    seed: str = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, seed: str) -> Column:
    """Uniform in [0, 1), a function of the id and the seed alone."""
    hexed = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(hexed, 1, 13), 16, 10).cast("double") / F.lit(DRAW)


def source_targets(sizes: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    All targets are level * weight, or most * size where that is less, and add up to all sizes. The
    level is found by capping what is above it and sharing the rest anew, until nothing more is
    capped. Only sums over the sources reach the driver.
    """
    ranked = dense_index(sizes, [F.isnull("source"), F.col("source")], "sources", "rank")
    weights = F.array(*map(F.lit, params.weights))
    s = saved(ranked.select("source", "source_size", F.element_at(weights, (F.pmod("rank", F.lit(len(params.weights))) + 1).cast("int")).cast("long").alias("weight"), (F.col("source_size") * params.most).alias("cap")), "weights")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    capped, free, left, weight = -1, None, total, None
    above = F.lit(False)
    while True:
        n, spent, free = s.agg(F.count_if(above), F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if n == capped or not free:
            break
        capped, left, weight = n, total - spent, free
        above = F.col("cap") * F.lit(weight) < F.lit(left) * F.col("weight")
    level = F.lit(float(left)) / F.lit(float(weight or 1))
    target = F.when(above, F.col("cap").cast("double")).otherwise(level * F.col("weight"))
    return s.select("source", "source_size", target.alias("target"))


def mix_plan(sized: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """(doc_id, source, size) -> the same with source_size, target and copies."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = saved(source_targets(sizes, params), "targets").withColumnRenamed("source", "of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # Spark broadcasts the targets where their written size is under its threshold; beyond that it
    # joins by source, and a hot source's rows are split by adaptive execution
    joined = sized.join(targets, sized["source"].eqNullSafe(targets["of"])).drop("of").withColumn("rate", rate)
    copies = F.floor("rate") + F.when(draw(F.col("doc_id"), params.seed) < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return joined.withColumn("copies", copies.cast("long")).drop("rate")


def mix_documents(docs: DataFrame, params: MixParams = MixParams(), text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The rows of docs, each as often as the mix takes it, with all their columns."""
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("kept_row"), F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    sizes = saved(whole.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    targets = saved(source_targets(sizes, params), "targets").withColumnRenamed("source", "of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = whole.drop("size").join(targets, whole["source"].eqNullSafe(targets["of"])).withColumn("rate", rate)
    copies = F.floor("rate") + F.when(draw(F.col("doc_id"), params.seed) < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    times = F.array_repeat(F.lit(0), copies.cast("int"))
    return joined.select("kept_row", F.explode(times)).select("kept_row.*")


def mix_report(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """One row per row of docs: doc_id, size, source_size, target, copies and taken = size * copies."""
    sized = saved(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    plan = mix_plan(sized, params)
    return plan.select("doc_id", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))
