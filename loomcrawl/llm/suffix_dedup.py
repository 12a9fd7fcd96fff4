"""Removal of every byte that an earlier copy of a 100-byte string covers, exact at byte level.

Order is that of doc_id, then of the row as read, then of the place in the text. To sort all suffixes of a corpus is
to sort mostly suffixes that have no copy, so those that may have one are found first:

1. Anchors. Of every `span` bytes, the `key` bytes with the least hash are an anchor: equal strings of `span` bytes have
   the same anchor at the same place. Hashes of anchors are counted, and those seen twice go to a Bloom filter of
   fixed size (it may fill up: then more anchors go on, and the result is the same).
2. Contexts. All `span`-byte strings with an anchor lie in its context, span - key bytes before it and span after its
   first. Anchors in the filter are grouped by context: the first of a context keeps what it has first, all others
   repeat it whole. Batches hand on one anchor a context at most, so copies cost a row or two a batch.
3. Suffixes. Contexts that share an anchor but differ may share some of their strings. Their suffixes, to the right of
   the anchor and, read backwards, to the left of it, are sorted deep-shallow (suffix_sort.py): contexts share a string
   when both its halves lie in runs of long enough common prefixes. The first of each is told by order.
   An anchor with more than `block` unlike contexts is not sorted in one task: these
   are cut into their strings, which are grouped as rows.
4. Cut. Each text reads which of its strings are repeats, and is cut once.

Contexts are told apart by 128 bits of hash in step 2, and byte by byte in step 3 (by sha256 beyond `block`). Texts are
written once as a table of numbered rows in blocks of some MB, and stay where they are read: what moves are anchors.

A null or empty text has nothing to remove. A null doc_id is below all others; rows that share a doc_id are documents of
their own, the one read first first. Matches never cross documents. An empty table gives an empty result. Other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bloom import fixed_filter, in_filter
from .common import numbered_texts, saved
from .hashing import mix, power_tables
from .suffix_sort import deep_shallow, shared_with_previous

#: No byte of UTF-8: what a context has beyond the ends of its text.
NONE = 0xFF
#: Bytes of short texts whose anchors are found together, contexts cut out at once, contexts sorted at once.
TOGETHER, AT_ONCE, SORTED = 1 << 18, 1 << 15, 1 << 16
#: Rows of a block: 2^13.
ROW_BITS = 13
SIGNED = 1 << 63
#: Hashes of anchors are counted by their upper 40 bits.
SHORT = np.uint64(24)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_OTHER = mix(np.arange(257, 513, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def rows_block(row: str) -> Column:
    return F.shiftright(row, ROW_BITS)


@dataclass(frozen=True)
class SuffixParams:
    span: int = 100
    #: Bytes of an anchor; span - key + 1 strings have one, 63 at most.
    key: int = 40
    #: Bits of the filter of repeated anchors: 16 MB.
    filter_bits: int = 1 << 27
    #: Bytes of a suffix that quicksort looks at.
    shallow: int = 24
    #: Contexts of an anchor that one task sorts: 10 MB.
    block: int = 1 << 16

    @property
    def before(self) -> int:
        return self.span - self.key


def sliding(v: np.ndarray, n: int, least) -> np.ndarray:
    """least of each n neighbours."""
    size = 1
    while 2 * size <= n:
        v, size = least(v[:-size], v[size:]), 2 * size
    return least(v[: len(v) - (n - size)], v[n - size :]) if size < n else v


def anchors(data: np.ndarray, ends: np.ndarray, p: SuffixParams) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of some texts of span bytes or more, one after another up to their ends."""
    up, down = power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], dtype=np.uint64, out=total[1:])
    h = mix((total[p.key :] - total[: -p.key]) * down[: len(data) - p.key + 1]) | np.uint64(1)
    least = sliding(h, p.before + 1, np.minimum)
    for end in ends[:-1]:  # no string crosses from text to text
        least[end - p.span + 1 : end] = 0
    edge = np.zeros(p.before, np.uint64)
    at = np.flatnonzero(sliding(np.concatenate((edge, least, edge)), p.before + 1, np.maximum) == h)
    return at, h[at]


@dataclass
class Found:
    """Anchors of some texts (numbers in a list): of is the place of each one's text among them, at its place there, place that in data (their bytes), h its hash."""

    some: list[int]
    of: np.ndarray
    at: np.ndarray
    h: np.ndarray
    data: np.ndarray
    place: np.ndarray


def text_anchors(texts: list[bytes], p: SuffixParams) -> Iterator[Found]:
    """The anchors of texts, of many short ones or of a part of a long one at a time; where parts meet one may come twice."""
    some, size = [], 0
    for k, t in enumerate(texts):
        if len(t) > TOGETHER:
            for first in range(0, len(t) - p.span + 1, TOGETHER):
                # strings that begin in the part, and what their contexts reach
                low, stop = max(0, first - p.before), min(len(t), first + TOGETHER + p.span - 1)
                at, h = anchors(np.frombuffer(t, np.uint8)[first:stop], np.array([stop - first]), p)
                yield Found([k], np.zeros(len(at), np.int64), at + first, h, np.frombuffer(t, np.uint8)[low : stop + p.span], at + first - low)
        elif len(t) >= p.span:
            some.append(k)
            size += len(t)
        if some and (size >= TOGETHER or k == len(texts) - 1):
            ends = np.cumsum([len(texts[i]) for i in some])
            data = np.frombuffer(b"".join([texts[i] for i in some]), np.uint8)
            at, h = anchors(data, ends, p)
            of = np.searchsorted(ends, at, "right")
            yield Found(some, of, at - np.concatenate(([0], ends))[of], h, data, at)
            some, size = [], 0


def contexts(texts: list[bytes], of: np.ndarray, at: np.ndarray, p: SuffixParams) -> Iterator[tuple[slice, np.ndarray]]:
    """Of anchors at `at` of the texts `of`: their contexts, a row each, some at a time."""
    if not len(of):
        return
    pad = bytes([NONE]) * p.before, bytes([NONE]) * p.span
    used = np.unique(of)
    base = np.zeros(len(texts), np.int64)
    base[used] = np.cumsum([0, *(len(texts[k]) + p.before + p.span for k in used[:-1])])
    data = np.frombuffer(b"".join(x for k in used for x in (pad[0], texts[k], pad[1])), np.uint8)
    rows = np.lib.stride_tricks.sliding_window_view(data, p.before + p.span)
    for k in range(0, len(of), AT_ONCE):
        here = slice(k, min(len(of), k + AT_ONCE))
        yield here, rows[base[of[here]] + at[here]]


def context_hash(found: Found, sizes: np.ndarray, p: SuffixParams) -> np.ndarray:
    """A hash of the context of each anchor, of a text of a size, from sums of its bytes; what is beyond a text's ends is told by their distance."""
    up, down = power_tables(len(found.data) + 1)
    total = np.zeros(len(found.data) + 1, np.uint64)
    np.cumsum(_OTHER[found.data] * up[: len(found.data)], dtype=np.uint64, out=total[1:])
    before, after = np.minimum(found.at, p.before), np.minimum(sizes - found.at, p.span)
    a, b = found.place - before, found.place + after
    return mix(mix((total[b] - total[a]) * down[a]) + (before * 1024 + after).astype(np.uint64))


def _texts(column: pa.Array) -> list[bytes]:
    return [t.as_py() or b"" for t in column.cast(pa.binary())]


def _hashes(p: SuffixParams):
    """(h): 40 bits of the hash of each anchor, twice where a batch has it again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [x.h for x in text_anchors(_texts(b.column(0)), p)]
            if found:
                h, n = np.unique(np.concatenate(found) >> SHORT, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.astype(np.int64)), pa.array(n)], ["h", "n"])

    return run


def repeat_filter(rows: DataFrame, p: SuffixParams) -> Broadcast:
    """A Bloom filter of the anchors that occur twice or more."""
    hashes = rows.select("text").mapInArrow(_hashes(p), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    return fixed_filter(hashes, p.filter_bits)


def maybe_repeated(filt: Broadcast, h: np.ndarray) -> np.ndarray:
    return np.flatnonzero(in_filter(filt.value, h >> SHORT))


def _ends(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal rows of sorted keys begins."""
    return np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1)))) if len(keys) else np.empty(0, np.int64)


def _first_anchors(p: SuffixParams, filt):
    """(h, c, ord, row, at): of a batch's anchors in the filter the first of each context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, ord_ = b.column(0).to_numpy(), b.column(1).to_numpy()
            texts, found = _texts(b.column(2)), []
            size = np.array([len(t) for t in texts], np.int64)
            for x in text_anchors(texts, p):
                text = np.array(x.some)[x.of]
                c = context_hash(x, size[text], p)
                k = maybe_repeated(filt, x.h)
                found.append(np.stack([x.h[k].view(np.int64), c[k].view(np.int64), ord_[text[k]], row[text[k]], x.at[k]], 1))
            if found:
                x = np.concatenate(found)
                x = x[np.lexsort(x.T[::-1])]
                x = x[_ends(x[:, :2])]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in x.T], ["h", "c", "ord", "row", "at"])

    return run


def first_contexts(rows: DataFrame, p: SuffixParams, filt) -> DataFrame:
    """(h, ord, row, at): the first anchor of each context."""
    found = rows.select("row", "ord", "text").mapInArrow(_first_anchors(p, filt), "h long, c long, ord long, row long, at long")
    return saved(found.groupBy("h", "c").agg(F.min(F.struct("ord", "row", "at")).alias("f")).select("h", "f.ord", "f.row", "f.at"), "suffix-contexts")


def _cut_out(p: SuffixParams):
    """Of a block's texts the contexts asked for: (h, n, ord, row, at, low, high, context); strings from low to high bytes before the anchor lie in the text."""

    def run(texts: pa.Table, asked: pa.Table) -> pa.Table:
        row, known = texts["row"].to_numpy(), _texts(texts["text"].combine_chunks())
        sort = np.argsort(row)
        of, at = sort[np.searchsorted(row, asked["row"].to_numpy(), sorter=sort)] if asked.num_rows else np.empty(0, np.int64), asked["at"].to_numpy()
        size = np.array([len(t) for t in known], np.int64)[of]
        cut = [pa.Array.from_buffers(pa.binary(), len(c), [None, pa.py_buffer((np.arange(len(c) + 1) * c.shape[1]).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(c))]) for _, c in contexts(known, of, at, p)]
        low, high = np.maximum(0, p.span - (size - at)), np.minimum(p.before, at)
        return pa.table([asked["h"], asked["n"], asked["ord"], asked["row"], asked["at"], pa.array(low, pa.int32()), pa.array(high, pa.int32()), pa.chunked_array(cut, pa.binary())], names=["h", "n", "ord", "row", "at", "low", "high", "context"])

    return run


def repeated_strings(context: np.ndarray, group: np.ndarray, low: np.ndarray, high: np.ndarray, p: SuffixParams) -> np.ndarray:
    """For contexts of several anchors (groups), each group's in their order: bit x is set where the string that begins x bytes before the anchor is one of an earlier context."""
    sides = np.ascontiguousarray(context[:, p.before :]), np.ascontiguousarray(context[:, : p.before][:, ::-1])
    orders, shared = [], []
    for side in sides:
        # suffixes to the right all begin with the anchor
        order = deep_shallow(side, group, p.shallow + (p.key if side is sides[0] else 0))
        orders.append(order)
        shared.append(shared_with_previous(side, group, order))
    bits = np.zeros(len(context), np.int64)
    kind = [np.empty(len(context), np.int64) for _ in sides]
    for x in range(p.before + 1):
        for k, need in enumerate((p.span - x, x)):
            kind[k][orders[k]] = np.cumsum(shared[k] < need)
        has = np.flatnonzero((low <= x) & (x <= high))
        key = kind[0][has] * (len(context) + 1) + kind[1][has]
        again = np.ones(len(has), bool)
        again[np.unique(key, return_index=True)[1]] = False
        bits[has[again]] |= 1 << x
    return bits


def _sorted(p: SuffixParams):
    """(row, at, bits) from contexts that come sorted by (h, ord, row, at): whole anchors at a time, some thousand contexts."""

    def done(t: pa.Table) -> pa.RecordBatch:
        flat = t["context"].combine_chunks()
        context = np.frombuffer(flat.buffers()[2], np.uint8)[flat.offset * (p.before + p.span) :][: len(flat) * (p.before + p.span)].reshape(len(flat), -1)
        bits = repeated_strings(context, t["h"].to_numpy(), t["low"].to_numpy(), t["high"].to_numpy(), p)
        return pa.RecordBatch.from_arrays([t["row"].combine_chunks(), t["at"].combine_chunks(), pa.array(bits)], ["row", "at", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for b in batches:
            h = b.column(0).to_numpy()
            if held and n >= SORTED:
                last = held[-1].column(0)[-1].as_py()
                cut = int(np.argmax(h != last)) if (h != last).any() else len(h)
                held.append(b.slice(0, cut))
                n += cut
                if cut == len(h):
                    continue
                yield done(pa.Table.from_batches(held))
                b, held, n = b.slice(cut), [], 0
            held.append(b)
            n += b.num_rows
        if n:
            yield done(pa.Table.from_batches(held))

    return run


def _grouped(many: DataFrame, p: SuffixParams) -> DataFrame:
    """(row, at, bits) of contexts of an anchor that has many: every string is a row, the first of equal ones is known by a minimum."""
    each = many.withColumn("x", F.explode(F.sequence("low", "high")))
    each = saved(each.select("h", "x", F.unhex(F.sha2(F.substring("context", p.before + 1 - F.col("x"), F.lit(p.span)), 256)).alias("sha"), F.struct("ord", "row", "at").alias("o")), "suffix-strings")
    first = saved(each.groupBy("h", "x", "sha").agg(F.min("o").alias("first"), F.count("*").alias("n")).where("n > 1").select(F.col("h").alias("of"), F.col("x").alias("by"), F.col("sha").alias("is"), "first"), "suffix-firsts")
    again = each.join(first, (F.col("h") == F.col("of")) & (F.col("x") == F.col("by")) & (F.col("sha") == F.col("is"))).where("o <> first")
    return again.groupBy("o.row", "o.at").agg(F.bit_or(F.expr("shiftleft(1L, x)")).alias("bits"))


def repeat_bits(rows: DataFrame, first: DataFrame, p: SuffixParams) -> DataFrame:
    """(row, at, bits) of first anchors some of whose strings an earlier context has."""
    counts = saved(first.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").withColumnRenamed("h", "of"), "suffix-anchors")
    asked = first.join(counts, F.col("h") == F.col("of")).select(rows_block("row").alias("block"), "h", "n", "ord", "row", "at")
    schema = "h long, n long, ord long, row long, at long, low int, high int, context binary"
    told = saved(rows.select("block", "row", "text").groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(_cut_out(p), schema), "suffix-cut")
    few = told.where(f"n <= {p.block}").repartition("h").sortWithinPartitions("h", "ord", "row", "at").select("h", "row", "at", "low", "high", "context")
    bits = few.mapInArrow(_sorted(p), "row long, at long, bits long").where("bits <> 0")
    return saved(bits.unionByName(_grouped(told.where(f"n > {p.block}"), p)), "suffix-bits")


def removed_runs(size: int, at: np.ndarray, bits: np.ndarray, p: SuffixParams) -> np.ndarray:
    """Begin and end of the runs of bytes of one text that repeated strings cover; bit x of an anchor: the string that begins x bytes before it."""
    begins = np.zeros(size + 1, np.int8)
    back = np.arange(p.before + 1)
    for k in range(0, len(at), AT_ONCE):
        here = slice(k, k + AT_ONCE)
        begin = (at[here, None] - back)[bits[here, None] >> back & 1 == 1]
        begins[begin[(begin >= 0) & (begin + p.span <= size)]] = 1
    edge = np.flatnonzero(np.diff(begins, prepend=np.int8(0)))
    first, last = edge[::2], edge[1::2] + p.span - 1
    if not len(first):
        return np.empty((0, 2), np.int64)
    apart = np.flatnonzero(first[1:] > last[:-1])
    return np.stack([first[np.append(0, apart + 1)], last[np.append(apart, len(last) - 1)]], 1)


OUT = "row long, doc_id long, n_bytes long, removed array<struct<begin:long,end:long>>, kept binary"


def _cut(p: SuffixParams, filt):
    """Of a block's texts what is removed and what stays. first: its first anchors, with the bits that earlier contexts have."""
    all_bits = (1 << p.before + 1) - 1

    def run(texts: pa.Table, first: pa.Table) -> pa.Table:
        row, known = texts["row"].to_numpy(), _texts(texts["text"].combine_chunks()) if texts.num_rows else []
        key = np.stack([first["row"].to_numpy(), first["at"].to_numpy()], 1) if first.num_rows else np.empty((0, 2), np.int64)
        sort = np.lexsort(key.T[::-1])
        key, own = key[sort], first["bits"].to_numpy()[sort]
        starts = _ends(key)
        key, own = key[starts], np.bitwise_or.reduceat(own, starts) if len(starts) else own
        places: dict[int, list[np.ndarray]] = {}
        runs = [np.empty((0, 2), np.int64)] * len(known)
        for x in text_anchors(known, p):
            k = maybe_repeated(filt, x.h)
            of, at = x.of[k], x.at[k]
            for i, part in zip(np.unique(of).tolist(), np.split(at, np.flatnonzero(np.diff(of)) + 1)):
                places.setdefault(x.some[i], []).append(part)
        for i, parts in places.items():
            mine = np.concatenate(parts)
            a, b = np.searchsorted(key[:, 0], [row[i], row[i] + 1])
            bits = np.full(len(mine), all_bits, np.int64)
            if b > a:
                place = np.minimum(a + np.searchsorted(key[a:b, 1], mine), b - 1)
                bits = np.where(key[place, 1] == mine, own[place], bits)
            runs[i] = removed_runs(len(known[i]), mine, bits, p)
        kept = [b"".join(t[i:j] for i, j in zip([0, *r[:, 1].tolist()], [*r[:, 0].tolist(), len(t)])) if len(r) else t for t, r in zip(known, runs)]
        told = [[{"begin": a, "end": b} for a, b in r.tolist()] for r in runs]
        n = pa.array([len(t) for t in known], pa.int64())
        return pa.table([texts["row"], texts["doc_id"], n, pa.array(told, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())], names=["row", "doc_id", "n_bytes", "removed", "kept"])

    return run


def remove_repeats(docs: DataFrame, params: SuffixParams = SuffixParams(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of docs: row (a number of its own), doc_id, n_bytes, removed (runs of bytes, in order), kept (the remaining bytes)."""
    p = params
    columns = {"doc_id": F.col(doc_id).cast("long"), "ord": F.coalesce(F.col(doc_id).cast("long"), F.lit(-SIGNED)), "text": F.col(text)}
    rows = numbered_texts(docs, "suffix-rows", columns, ROW_BITS)
    filt = repeat_filter(rows, p)
    first = first_contexts(rows, p, filt)
    bits = repeat_bits(rows, first, p)
    side = first.select("row", "at", F.lit(0).cast("long").alias("bits")).unionByName(bits).select(rows_block("row").alias("block"), "row", "at", "bits")
    return rows.select("block", "row", "doc_id", "text").groupBy("block").cogroup(side.groupBy("block")).applyInArrow(_cut(p, filt), OUT)


def repeat_report(docs: DataFrame, params: SuffixParams = SuffixParams()) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["begin"])
    return remove_repeats(docs, params).select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
