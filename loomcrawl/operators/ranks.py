"""Dense ids in a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcrawl.operators.scratch import saved


def dense_ids(df: DataFrame, order: list[str | Column], out: str, name: str = "ranks") -> DataFrame:
    """df with a gapless long from 0 in the order given; ties get any order among themselves.

    A range sort deals rows out; inside each partition the place is counted, and one count per
    partition is summed up. No task sees more than its range of rows.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    rows = saved(ranged, name)
    part = F.shiftright("_at", 33)
    counts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # one row per partition of the range sort, whatever the number of rows is
    before = counts.selectExpr("_part", "coalesce(sum(_n) over (order by _part rows between unbounded preceding and 1 preceding), 0) as _before")
    placed = rows.withColumn("_part", part).join(F.broadcast(before), "_part")
    return placed.withColumn(out, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_part", "_before", "_at")
