"""SimHash near-dedup by anchor-point covering.

A fingerprint has 64 bits, from the 3-word shingles of a text. The anchors are the 2^57 words of the
[63, 57] Hamming code on the first 63 bits: perfect, so every fingerprint lies within covering radius
1 of exactly one anchor. Two fingerprints that differ in t bits or fewer both lie within ceil(t/2) of
a point between them, and that point lies within the covering radius of an anchor; replicating every
fingerprint to all anchors within 1 + ceil(t/2) so brings each such pair together at some anchor. For
t = 2 that is radius 2 and at most 32 anchors, found from the syndrome without a search. (The full
radius 1 + t finds the same pairs at 652 anchors a fingerprint; see the README.)

An anchor holds at most 4034 distinct fingerprints (those within 2 of it, times the free 64th bit),
however many documents there are: a bounded group. Documents with equal fingerprints are one entry.
At an anchor the entries are compared among themselves and one link per entry that is not the first
of its cluster leaves the task, not all pairs. Components over these links give the groups.

A null text is an empty one; a text without words has fingerprint 0, which links like any other.
Fingerprints are linked by themselves, whatever the ids of their rows. Rows that share a doc_id each get
a row. A component is named by its smallest doc_id; a null doc_id names none unless all are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, saved, without
from .components import components
from .substring import SubstringParams, similar_documents

SEED = 42
SHINGLE = 3
THRESHOLD = 2
CODE_BITS = 63
#: Shingle hashes that are unpacked to bits at once.
BLOCK = 1 << 15


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    words = (text or b"").lower().split()  # of bytes, both touch ASCII alone
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)  # one h: its set bits are in over half of all
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-shingle] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), BLOCK):
        part = h[i : i + BLOCK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(((2 * ones > len(h)).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def _signed(values) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_signed([fingerprint(t.as_py()) for t in b.column(1).cast(pa.binary())]))], ["doc_id", "fp"])


def syndrome(points: np.ndarray) -> np.ndarray:
    """XOR of the places (1 to 63) of the set bits among the first 63."""
    s = np.zeros(len(points), np.uint64)
    for i in range(CODE_BITS):
        s ^= ((points >> np.uint64(i)) & np.uint64(1)) * np.uint64(i + 1)
    return s


def _pair_masks() -> np.ndarray:
    """For each syndrome s from 1 to 63: the mask of place s, and of the 31 pairs of places with XOR s."""
    bit = lambda i: 1 << (i - 1)
    rows = [[0] * 32] + [[bit(s), *(bit(i) | bit(i ^ s) for i in range(1, 64) if i < i ^ s)] for s in range(1, 64)]
    return np.array(rows, np.uint64)


def anchors_within_2(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of point, anchor) for all code words within 2 of each point's first 63 bits."""
    low = points & np.uint64((1 << CODE_BITS) - 1)
    s = syndrome(low)
    on = np.flatnonzero(s == 0)  # code words themselves; the next one is 3 away
    off = np.flatnonzero(s)
    near = low[off, None] ^ _pair_masks()[s[off]]
    return np.concatenate([on, np.repeat(off, 32)]), np.concatenate([low[on], near.ravel()])


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, 4096):
            part = b.slice(i, 4096)
            fp, rep = part.column(0).to_numpy(), part.column(1)
            at, anchor = anchors_within_2(fp.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(fp[at]), rep.take(pa.array(at))], ["anchor", "fp", "rep"])


def link_group(fp: np.ndarray, rep: np.ndarray) -> list[tuple[int, int]]:
    """Links that join all entries within THRESHOLD of each other, through other entries of the group or not."""
    root = list(range(len(fp)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(1, len(fp)):
        for j in np.flatnonzero(np.bitwise_count(fp[:i] ^ fp[i]) <= THRESHOLD).tolist():
            root[find(i)] = find(j)
    return [(int(rep[i]), int(rep[find(i)])) for i in range(len(fp)) if find(i) != i]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by anchor; an anchor's rows may go on in the next batch."""
    held = [np.empty(0, np.int64)] * 3
    for b in batches:
        anchor, fp, rep = (np.concatenate([h, c.to_numpy()]) for h, c in zip(held, b.columns))
        last = int(np.searchsorted(anchor, anchor[-1])) if len(anchor) else 0
        held = [anchor[last:], fp[last:], rep[last:]]
        yield _links(anchor[:last], fp[:last], rep[:last])
    yield _links(*held)


def _links(anchor: np.ndarray, fp: np.ndarray, rep: np.ndarray) -> pa.RecordBatch:
    a, b = [], []
    if len(anchor):
        starts = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        sizes = np.diff(np.append(starts, len(anchor)))
        # pairs, most of the groups with more than one entry, in one go
        two = starts[sizes == 2]
        near = two[np.bitwise_count(fp[two].view(np.uint64) ^ fp[two + 1].view(np.uint64)) <= THRESHOLD]
        a, b = rep[near].tolist(), rep[near + 1].tolist()
        for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            for x, y in link_group(fp[s : s + n].view(np.uint64), rep[s : s + n]):
                a.append(x)
                b.append(y)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def fingerprint_groups(prints: DataFrame) -> DataFrame:
    """(of, component): the fingerprints (fp) that are linked with others, met at anchors."""
    entries = saved(prints.select("fp", F.col("fp").alias("rep")).distinct(), "entries")
    spread = entries.mapInArrow(_replicate, "anchor long, fp long, rep long")
    links = spread.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_compare, "a long, b long")
    return saved(components(links).withColumnRenamed("node", "of"), "groups")


def _met(prints: DataFrame) -> DataFrame:
    """(key, node) from (fp, node): nodes of linked or equal fingerprints share a key."""
    return prints.join(fingerprint_groups(prints), F.col("fp") == F.col("of"), "left").select(F.xxhash64(F.coalesce("component", "fp")).alias("key"), "node")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of docs: doc_id, fp (long, the fingerprint's bits), component_id."""
    prints = saved(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_fingerprints, "doc_id long, fp long"), "fingerprints")
    groups = fingerprint_groups(prints)
    labels = saved(prints.join(groups, F.col("fp") == F.col("of"), "left").select("doc_id", "fp", F.coalesce("component", "fp").alias("component")), "labels")
    lows = labels.groupBy("component").agg(F.min("doc_id").alias("component_id")).withColumnRenamed("component", "of")
    return labels.join(saved(lows, "component-ids"), F.col("component") == F.col("of")).select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", params: SubstringParams = SubstringParams()) -> DataFrame:
    """One row of each group of docs: that with the smallest doc_id, of rows that share it one; a null doc_id comes last.

    Groups are texts whose sets of params.shingle words have exact Jaccard params.similarity, or a chain of
    such texts. Texts whose fingerprints of such shingles are linked at anchors are compared, and, as a fingerprint of
    64 bits tells nothing of most pairs at that distance, so are those that meet in params.bands.
    """
    rows = numbered(docs, "rows")
    labels = similar_documents(rows.select("row", F.col("kept_row").getField(doc_id).cast("long").alias("doc_id"), F.col("kept_row").getField(text).alias("text")), params, lambda t: fingerprint(t, params.shingle), _met)
    many = labels.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("stays"), F.count("*").alias("n")).where("n > 1").withColumnRenamed("component", "of")
    gone = saved(labels.join(saved(many, "groups-of-many"), F.col("component") == F.col("of")).where("row <> stays.row").select("row"), "gone")
    return without(rows, gone)


def simhash_report(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
