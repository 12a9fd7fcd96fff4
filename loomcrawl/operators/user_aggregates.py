"""Aggregates that a user writes in Python, merged in a tree.

A user's class says how a state begins, takes a batch of rows, is merged with another, and ends. Tasks update states over
Arrow batches, a state per group, and hand on (group, state) rows; states of a group then meet in a tree: at each
level in one of several parts of their group, a part being a task's worth, until one is left. No level brings a group's rows
together, and a task holds the one state it is merging besides the groups of its own batches.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import Any, Protocol

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcrawl.functions.urls import domain


class UserAggregate(Protocol):
    """What a user writes. `columns` are read, `result` is the type of finish()'s values as a DDL string."""

    columns: tuple[str, ...]
    result: str

    def init(self) -> Any:
        """The state of no rows."""

    def update(self, state: Any, rows: pa.Table) -> Any:
        """The state after some rows of a group, with its columns by name."""

    def merge(self, a: Any, b: Any) -> Any:
        """The state of both; any order of merging must give the same."""

    def finish(self, state: Any) -> Any:
        """The value of a state."""


#: Groups whose states a task holds before it hands them on; parts in which states of a group are merged first, level by level.
HELD, PARTS = 50_000, (64, 8)


def _updated(agg: UserAggregate, keys: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[bytes, tuple[pa.RecordBatch, Any]] = {}
        task = TaskContext.get().partitionId()

        def out() -> pa.RecordBatch:
            heads = pa.Table.from_batches([k for k, _ in states.values()]).combine_chunks()
            done = pa.array([pickle.dumps(s) for _, s in states.values()], pa.binary())
            columns = [c.combine_chunks() for c in heads.columns] + [done, pa.array([task] * len(states), pa.int32())]
            return pa.RecordBatch.from_arrays(columns, [f"k{i}" for i in range(keys)] + ["state", "task"])

        for b in batches:
            if not b.num_rows:
                continue
            rows = pa.Table.from_batches([b]).append_column("_at", pa.array(range(b.num_rows), pa.int64()))
            names = rows.column_names[:keys]
            at = rows.select([*names, "_at"]).group_by(names).aggregate([("_at", "list")]) if names else pa.table({"_at_list": [list(range(b.num_rows))]})
            for i, places in enumerate(at["_at_list"].to_pylist()):
                head = b.select(names).slice(places[0], 1) if names else pa.RecordBatch.from_arrays([pa.nulls(1)], ["_"])
                key = pickle.dumps([c[0].as_py() for c in head.columns])
                mine = rows.take(pa.array(places)).select(range(keys, rows.num_columns - 1)).rename_columns(list(agg.columns))
                known = states.get(key)
                states[key] = (head if known is None else known[0], agg.update(agg.init() if known is None else known[1], mine))
            if len(states) >= HELD:
                yield out()
                states.clear()
        if states:
            yield out()

    return run


def _merged(agg: UserAggregate, keys: int):
    """States of one group follow one another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, state, known, task = None, None, None, TaskContext.get().partitionId()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*head.columns[:keys], pa.array([pickle.dumps(state)], pa.binary()), pa.array([task], pa.int32())], [f"k{i}" for i in range(keys)] + ["state", "task"])

        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                key = pickle.dumps([c[0].as_py() for c in row.columns[:keys]])
                more = pickle.loads(row.column(keys)[0].as_py())
                if key == known:
                    state = agg.merge(state, more)
                else:
                    if head is not None:
                        yield out()
                    head, state, known = row, more, key
        if head is not None:
            yield out()

    return run


def aggregate_by(df: DataFrame, by: list[str], agg: UserAggregate, out: str = "value") -> DataFrame:
    """(*by, out): a user's aggregate of each group; groups with a null key are groups too. Without `by` all rows are one group; of no rows that has no row."""
    keys = by or ["_all"]
    narrow = df.select(*((F.col(f"`{c}`") for c in by) if by else (F.lit(0),)), *(F.col(f"`{c}`") for c in agg.columns))
    narrow = narrow.toDF(*(f"k{i}" for i in range(len(keys))), *(f"c{i}" for i in range(len(agg.columns))))
    kinds = [f"k{i} {narrow.schema[i].dataType.simpleString()}" for i in range(len(keys))]
    names, schema = [f"k{i}" for i in range(len(keys))], ", ".join([*kinds, "state binary", "task int"])
    states = narrow.mapInArrow(_updated(agg, len(keys)), schema)
    for parts in (*PARTS, 1):
        part = F.pmod(F.xxhash64("task"), F.lit(parts)) if parts > 1 else F.lit(0)
        dealt = states.withColumn("part", part).repartition(*names, "part").sortWithinPartitions(*names, "part").drop("part")
        states = dealt.mapInArrow(_merged(agg, len(keys)), schema)
    done = agg.finish

    @F.arrow_udf(agg.result)
    def finish(state: pa.Array) -> pa.Array:
        return pa.array([done(pickle.loads(s)) for s in state.to_pylist()])

    return states.select(*(F.col(n).alias(c) for n, c in zip(names, by)), finish("state").alias(out))


class Support:
    """How often a group was seen: the sum of a column of increments, a null for none."""

    result = "long"

    def __init__(self, increment: str):
        self.columns = (increment,)

    def init(self) -> int:
        return 0

    def update(self, state: int, rows: pa.Table) -> int:
        return state + (pc.sum(rows[0]).as_py() or 0)

    def merge(self, a: int, b: int) -> int:
        return a + b

    def finish(self, state: int) -> int:
        return state


class Intersection:
    """What entries have in common by their supports: the smallest one, 0 if any is missing."""

    result = "long"

    def __init__(self, support: str):
        self.columns = (support,)

    def init(self) -> None:
        return None

    def update(self, state: int | None, rows: pa.Table) -> int | None:
        least = 0 if rows[0].null_count else pc.min(rows[0]).as_py()
        return self.merge(state, least)

    def merge(self, a: int | None, b: int | None) -> int | None:
        return b if a is None else a if b is None else min(a, b)

    def finish(self, state: int | None) -> int | None:
        return state


class DomainSupport:
    """How often a group was seen in each domain: the `top` most frequent, ties by name, as `domain count`; exact, so a state has all domains of its group."""

    result = "array<string>"

    def __init__(self, column: str, top: int = 10):
        self.columns, self.top = (column,), top

    def init(self) -> dict[str, int]:
        return {}

    def update(self, state: dict[str, int], rows: pa.Table) -> dict[str, int]:
        found = pc.value_counts(rows[0].combine_chunks())
        return self.merge(state, {r["values"]: r["counts"] for r in found.to_pylist() if r["values"] is not None})

    def merge(self, a: dict[str, int], b: dict[str, int]) -> dict[str, int]:
        out = dict(a)
        for k, n in b.items():
            out[k] = out.get(k, 0) + n
        return out

    def finish(self, state: dict[str, int]) -> list[str]:
        return [f"{k} {n}" for k, n in sorted(state.items(), key=lambda x: (-x[1], x[0]))[: self.top]]


# Queries


def user_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two thirds of all lines are one group."""
    x = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn("flag", F.when(F.col("l_orderkey") % 3 > 0, "all").otherwise(F.col("l_returnflag")))
    return aggregate_by(x.withColumn("n", F.when(F.col("l_linenumber") < 5, F.col("l_linenumber")).cast("long")), ["flag"], Support("n"), "support")


def user_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    support = F.when(F.col("o_orderkey") % 61 > 0, (F.col("o_totalprice") * 100).cast("long"))
    return aggregate_by(o.select("o_custkey", support.alias("support")), ["o_custkey"], Intersection("support"), "common")


def user_domain_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    url = F.concat(F.lit("http://h"), (F.col("event_id") * 7 % 23).cast("string"), F.lit(".example.org/"))
    return aggregate_by(e.select((F.col("user_id") % 5).alias("class"), domain(url).alias("domain")), ["class"], DomainSupport("domain", 4), "top").withColumn("top", F.array_join("top", ", "))


QUERIES = {f.__name__: f for f in (user_support, user_intersection, user_domain_support)}
ORACLE_SQL = {
    "user_support": "select case when l_orderkey % 3 > 0 then 'all' else l_returnflag end as flag, coalesce(sum(l_linenumber) filter (l_linenumber < 5), 0)::bigint as support from lineitem group by 1",
    "user_intersection": "select o_custkey, min(case when o_orderkey % 61 > 0 then trunc(o_totalprice * 100)::bigint else 0 end) as common from orders group by 1",
    "user_domain_support": """with c as (select user_id % 5 as class, 'h' || (event_id * 7 % 23) || '.example.org' as domain, count(*) as n from events group by 1, 2)
        select class, array_to_string(list(domain || ' ' || n order by n desc, domain)[1:4], ', ') as top from c group by 1""",
}
