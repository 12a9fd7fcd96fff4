"""Packing documents into sequences of a fixed capacity: large-item matching, then best fit.

Only a document longer than the capacity is cut, into pieces of full capacity and a last one. Pieces
longer than a third of the capacity are large: a sequence holds at most two of them, and each, from
the longest down, is matched with the longest large piece that still fits. The smaller pieces then
go, from the longest down, to the tightest gap that takes them; a new sequence opens where none does.

Lengths are whole numbers up to the capacity, so the plan needs no more than the count of each
length: it is made once, for all pieces together, from a table of at most `capacity` rows, in runs of
equal sequences. Each piece then finds its place from its rank among pieces of its length, which a
range sort of narrow rows gives. The ids are moved once, to join their places.

A null or empty text is a document of the end token alone. Rows that share a doc_id are documents of
their own. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dense_index, saved
from .tokens import encoder

#: Documents whose pieces are handed on together.
ROWS = 1000
PIECES = "doc_id long, piece int, start long, length int, ids binary"


@dataclass(frozen=True)
class PackParams:
    tokenizer: str
    kind: str = "words"
    end_id: int = 0
    capacity: int = 2048


def cut_pieces(docs: DataFrame, params: PackParams, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, piece, start, length, ids): ids are little-endian unsigned 16-bit, 32-bit for a large vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(params.tokenizer, params.kind)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                rows: list[tuple] = []
                for i, ids in zip(b.column(0).to_pylist(), enc.encode(t.as_py() for t in b.column(1).cast(pa.binary()))):
                    ids = np.append(ids, np.uint32(params.end_id)).astype("<u4")
                    for k, start in enumerate(range(0, len(ids), params.capacity)):
                        part = ids[start : start + params.capacity]
                        rows.append((i, k, start, len(part), pack_ids(part)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()))], ["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, PIECES)


def pack_ids(ids: np.ndarray) -> bytes:
    """Two bytes an id where all fit, told by a leading 2; else four, by a leading 4."""
    wide = len(ids) and int(ids.max()) > 0xFFFF
    return (b"\4" + ids.astype("<u4").tobytes()) if wide else (b"\2" + ids.astype("<u2").tobytes())


def unpack_ids(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u4" if packed[0] == 4 else "<u2", offset=1).astype("<u4")


@dataclass
class Run:
    """`bins` equal sequences, each with `n` pieces of each length in `parts`."""

    bins: int
    gap: int
    parts: tuple[tuple[int, int], ...]


def plan_runs(counts: dict[int, int], capacity: int) -> list[Run]:
    """Runs of equal sequences that hold all pieces; counts: pieces by length."""
    left, runs = Counter({k: v for k, v in counts.items() if v}), []
    large = sorted(k for k in left if 3 * k > capacity)
    while large:
        a = large[-1]
        i = bisect_left(large, capacity - a + 1) - 1
        if i < 0:
            runs.append(Run(left[a], capacity - a, ((a, 1),)))
            large.pop()
            continue
        b = large[i]
        if a == b:
            if pairs := left[a] // 2:
                runs.append(Run(pairs, capacity - 2 * a, ((a, 2),)))
            left[a] -= 2 * pairs
            if left[a]:  # an odd one goes with the longest shorter large piece, which fits too
                if i:
                    b = large[i - 1]
                    runs.append(Run(1, capacity - a - b, ((a, 1), (b, 1))))
                    left[b] -= 1
                else:
                    runs.append(Run(1, capacity - a, ((a, 1),)))
            large.pop()
        else:
            pairs = min(left[a], left[b])
            runs.append(Run(pairs, capacity - a - b, ((a, 1), (b, 1))))
            left[a] -= pairs
            left[b] -= pairs
            if not left[a]:
                large.pop()
        if b in large and b != a and not left[b]:
            large.remove(b)
    done = [r for r in runs if not r.gap]
    at = sorted((r.gap, i) for i, r in enumerate(runs) if r.gap)
    for s in sorted((k for k in left if 3 * k <= capacity and left[k]), reverse=True):
        n = left[s]
        while n:
            i = bisect_left(at, (s, -1))
            if i < len(at):
                gap, k = at.pop(i)
                run = runs[k]
            else:
                gap, run = capacity, Run(n, capacity, ())
            fit = gap // s  # the same sequence stays the tightest until it takes no more of them
            full = min(run.bins, n // fit)
            rest = min(n - full * fit, fit - 1) if full < run.bins else 0
            for bins, each in ((full, fit), (1 if rest else 0, rest)):
                if bins:
                    new = Run(bins, gap - each * s, (*run.parts, (s, each)))
                    n -= bins * each
                    runs.append(new)
                    done.append(new) if not new.gap else insort(at, (new.gap, len(runs) - 1))
            over = run.bins - full - (1 if rest else 0)
            if over and run.parts:
                runs.append(Run(over, gap, run.parts))
                insort(at, (gap, len(runs) - 1))
    return done + [runs[i] for _, i in at]


def places(runs: list[Run]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: where each run's ranks begin, its pieces a sequence, first sequence, and offset."""
    base, by = 0, {}
    for r in runs:
        offset = 0
        for length, each in r.parts:
            by.setdefault(length, []).append((r.bins * each, each, base, offset))
            offset += length * each
        base += r.bins
    out = {}
    for length, rows in by.items():
        n, each, first, offset = (np.array(c, np.int64) for c in zip(*rows))
        out[length] = (np.cumsum(n) - n, each, first, offset)
    return out


def pack(docs: DataFrame, params: PackParams, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids, sequence_id, offset."""
    pieces = saved(cut_pieces(docs, params, text, doc_id).withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    where = places(plan_runs(counts, params.capacity))
    first, before = {}, 0
    for length in sorted(counts):
        first[length] = before
        before += counts[length]
    told = docs.sparkSession.sparkContext.broadcast((where, first))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, first = told.value
        for b in batches:
            length, idx = b.column(0).to_numpy(), b.column(2).to_numpy()
            seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length).tolist():
                mine = np.flatnonzero(length == n)
                rank = idx[mine] - first[n]
                starts, each, base, offset = where[n]
                k = np.searchsorted(starts, rank, "right") - 1
                seq[mine] = base[k] + (rank - starts[k]) // each[k]
                off[mine] = offset[k] + (rank - starts[k]) % each[k] * n
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(seq), pa.array(off)], ["of", "sequence_id", "offset"])

    ranked = dense_index(pieces.select("length", "row"), [F.col("length"), F.col("row")], "ranks", "idx")
    placed = ranked.select("length", "row", "idx").mapInArrow(place, "of long, sequence_id long, offset long")
    return pieces.join(placed, pieces["row"] == placed["of"]).drop("row", "of")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, pieces): the pieces of a sequence in order; a sequence has `capacity` tokens at most."""
    return packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids"))).alias("pieces"))


def pack_report(docs: DataFrame, params: PackParams) -> DataFrame:
    """pack() with the CRC-32 of each piece's ids, as little-endian unsigned 32-bit integers, in their place."""

    @F.pandas_udf("long")
    def crc(ids):
        return ids.map(lambda x: zlib.crc32(unpack_ids(x).tobytes()))

    return pack(docs, params).select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), crc("ids").alias("ids_crc32"), "sequence_id", "offset")
