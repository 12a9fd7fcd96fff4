"""Entities from a stream of statements: state per document, closed by a watermark."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loomcrawl.operators.entities import MAX_DEPTH
from loomcrawl.operators.quads import RDF_TYPE

ENTITY = "graph string, subject string, props map<string,string>"
_STATE = "s array<string>, p array<string>, o array<string>, kind array<string>, pos array<long>"
_COLUMNS = ["s", "p", "o", "kind", "pos"]


def assemble(rows: list[tuple[str, str, str, str, int]], depth: int = MAX_DEPTH) -> list[tuple[str, dict[str, str]]]:
    """(subject, props) of one document from its statements (s, p, o, kind, pos), as the batch operator has them."""
    by: dict[str, list[tuple[str, str, str, int]]] = {}
    for s, p, o, kind, pos in rows:
        by.setdefault(s, []).append((p, o, kind, pos))
    out = []
    for s in sorted({r[0] for r in rows if r[1] == RDF_TYPE}):
        found: dict[str, tuple[int, str]] = {}
        level = [s]
        for step in range(depth + 1):
            below = []
            for n in level:
                for p, o, kind, pos in by.get(n, ()):
                    if kind == "bnode":
                        below.append(o)
                    elif p not in found or (pos, o) > found[p]:
                        found[p] = (pos, o)
            level = below
            if not level or step == depth:
                break
        out.append((s, {p: o for p, (_, o) in sorted(found.items())}))
    return out


def streaming_entities(quads: DataFrame, ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """Entities of each document (graph) once the watermark has passed its last statement.

    quads: a stream of s, p, o, o_kind, pos, graph and an event time. Statements that come after their
    document was closed start it anew, unless they are behind the watermark, where Spark drops them.
    State is one document's statements.
    """

    def step(key: tuple[str], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = list(zip(*state.get)) if state.exists else []
        if state.hasTimedOut:
            state.remove()
            found = assemble(rows)
            yield pd.DataFrame({"graph": [key[0]] * len(found), "subject": [s for s, _ in found], "props": [p for _, p in found]})
            return
        last = state.getCurrentWatermarkMs()
        for b in batches:
            rows += list(zip(b.s, b.p, b.o, b.o_kind, b.pos.astype(int)))
            last = max(last, int(b["at"].max()))
        state.update(tuple(map(list, zip(*rows))))
        state.setTimeoutTimestamp(last + 1)

    timed = quads.withWatermark(ts, delay).withColumn("at", F.unix_millis(F.col(ts)))
    return timed.groupBy("graph").applyInPandasWithState(step, ENTITY, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def windowed_counts(events: DataFrame, ts: str, key: str, length: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """(window, key, n): counts by tumbling event-time windows; late rows within the delay count."""
    return events.withWatermark(ts, delay).groupBy(F.window(ts, length), key).agg(F.count("*").alias("n"))
