"""Substring dedup by paragraph MinHash banding.

Paragraphs are of two kinds. Lines with at least `min_words` words are one. The others, passages, are
windows of `window` words over the whole word sequence of a text, across its lines: a window begins
where a shingle's hash is the least of `reach` neighbouring ones, which depends on those words alone, so
a repeated passage has its windows at the same places wherever it stands. Every `reach` shingles hold such
a place: of a passage of window + reach - 1 words or more at least one whole window is found, and windows
follow one another without a gap, as they are no shorter than the places are apart.

Each line has a MinHash signature over its 5-word shingles, cut into bands; lines that collide in a band
are compared by the exact Jaccard similarity of their shingle sets, those at 0.8 or more are linked, and
components of links are clusters. A pair at 0.8 collides with probability 0.997 (8 bands of 3 rows), one at
0.9 with 0.99997. Passages are linked at Jaccard 1: their one band is the hash of their words. (One word
changed inside a window takes 5 of its 21 shingles, so windows are mostly equal or not alike; bands for
those that differ at an end cost more than is gained, see the README.)

A cluster counts when it holds texts of two documents or more; repeats within one document are left to
quality rules. In each cluster the document with the smallest doc_id keeps its paragraph. Spans that
overlap or follow one another in a document are joined, and spans of fewer than `min_words` words in
all are dropped: common short phrases and short lines on their own stay as they are.

Equal paragraphs are one node. A task hands on each node once a batch and, where it is in several
documents, once in all, so a hot passage costs a task a row or two. Buckets with one node end there. A
bucket beyond `block` nodes is dealt out in blocks that share sixteen pivots, so that no task gets a hot
bucket whole. Where that leaves more than one cluster, nodes outside the largest are compared with all blocks, if these are
few; in larger buckets nodes meet again by the shingles that all pairs at the similarity must share (each
set's rarest ones, as many as it may lack and one more): no link is lost, and nodes that are not alike do not meet. Hashes have 64 bits.

Words are compared with A-Z in lower case. A null text has no spans. Rows that share a doc_id are one
document; rows with a null doc_id are left out. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dense_index, numbered, saved
from .components import components
from .hashing import mix, range_hashes, words

SPANS = "doc_id long, start int, end int, first int, last int, node long"
PIVOTS = 16
#: Told apart from a line of the same words.
PASSAGE = np.uint64(1)


@dataclass(frozen=True)
class SubstringParams:
    shingle: int = 5
    similarity: float = 0.8
    bands: int = 8
    rows: int = 3
    min_words: int = 20
    window: int = 25
    reach: int = 25
    #: Nodes of a bucket that one task compares.
    block: int = 512
    #: Blocks of a bucket in which each node that is outside its largest cluster is compared with all; in more they meet by rare shingles.
    direct: int = 16
    #: Places of paragraphs to verify that are sent to all executors, at most, some 60 bytes each; more are joined.
    send: int = 500_000


def shingles(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word shingles of a text's word hashes; of the whole if it is shorter."""
    at = np.arange(max(1, len(h) - n + 1)) if len(h) else np.arange(0)
    return range_hashes(h, at, np.minimum(at + n, len(h)))


def ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, … for size[0] numbers, then the same for the next."""
    end = np.cumsum(size)
    return np.arange(int(end[-1]) if len(end) else 0) + np.repeat(begin - (end - size), size)


def anchors(sh: np.ndarray, first: np.ndarray, last: np.ndarray, reach: int) -> np.ndarray:
    """Places of the least of each `reach` neighbouring shingles of one document, of equal ones the last; first, last: documents of their words."""
    n = len(sh) - reach + 1
    if n < 1:
        return np.empty(0, np.int64)
    value, at, size = sh, np.arange(len(sh)), 1

    def least(by: int) -> None:
        nonlocal value, at
        left, right = slice(0, len(value) - by), slice(by, None)
        value, at = np.minimum(value[left], value[right]), np.where(value[right] <= value[left], at[right], at[left])

    while 2 * size <= reach:
        least(size)
        size *= 2
    if size < reach:
        least(reach - size)
    at = at[first[:n] == last[reach - 1 :]]
    return at[np.concatenate(([True], at[1:] != at[:-1]))] if len(at) else at


def band_keys(sh: np.ndarray, begin: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """The MinHash bands of sets of shingles that lie one after another, each from its place in begin on."""
    mins = np.empty((len(begin), bands * rows), np.uint64)
    for k in range(bands * rows):
        one = sh * np.uint64(2 * k + 0x9E3779B97F4A7C15 & (1 << 64) - 1 | 1)  # another order of the shingles, by a product and its upper half
        mins[:, k] = np.minimum.reduceat((one ^ (one >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93 + 4 * k), begin)
    flat = mix(mins.ravel())
    start = np.arange(0, len(flat), rows)
    return mix(range_hashes(flat, start, start + rows).reshape(-1, bands) + np.arange(bands, dtype=np.uint64)).view(np.int64)


@dataclass
class Paragraphs:
    """of (the text's place in a list), first and last word in the text (last excluded), start and end code points, node, and bands if asked for."""

    of: np.ndarray
    first: np.ndarray
    last: np.ndarray
    start: np.ndarray
    end: np.ndarray
    node: np.ndarray
    bands: np.ndarray | None = None


def paragraphs(texts: list[bytes], p: SubstringParams, banded: bool = False) -> tuple[Paragraphs, Paragraphs]:
    """The lines and the passages of some texts, in their order."""
    data = b"\n".join(texts)
    h, s, e = words(data.lower())
    h = mix(h)
    b = np.frombuffer(data, np.uint8)
    base = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    line = np.searchsorted(np.flatnonzero(b == 10), s)
    edge = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1]))) if len(s) else np.empty(0, np.int64)
    stop = np.append(edge[1:], len(h))[: len(edge)]
    long = stop - edge >= p.min_words
    word = np.searchsorted(s, base)
    point = None if data.isascii() else np.concatenate(([0], np.cumsum((b & 0xC0) != 0x80)))
    at_point = (lambda k: k) if point is None else (lambda k: point[k])
    all_sh = shingles(h, p.shingle) if len(h) >= p.shingle else np.empty(0, np.uint64)

    def found(x: np.ndarray, y: np.ndarray) -> Paragraphs:
        node = range_hashes(h, x, y) if len(x) else np.empty(0, np.uint64)
        of = np.searchsorted(base, s[x], "right") - 1 if len(x) else x
        return Paragraphs(of, x - word[of], y - word[of], at_point(s[x]) - at_point(base[of]), at_point(e[y - 1]) - at_point(base[of]), node.view(np.int64))

    lines = found(x := edge[long], y := stop[long])
    if banded:
        count = y - x - p.shingle + 1  # one after another
        lines.bands = band_keys(all_sh[ragged(x, count)], np.cumsum(count) - count, p.bands, p.rows) if len(x) else np.empty((0, p.bands), np.int64)
    doc = np.searchsorted(base, s, "right")
    x = anchors(all_sh, doc[: len(all_sh)], doc[p.shingle - 1 :], p.reach)
    x = x[doc[np.minimum(x + p.window, len(doc)) - 1] == doc[x]] if len(x) else x
    x = x[x + p.window <= len(h)]
    passages = found(x, x + p.window)
    passages.node = mix(passages.node.view(np.uint64) + PASSAGE).view(np.int64)
    passages.bands = passages.node[:, None]
    return lines, passages


#: Bytes of text whose paragraphs are found together, and nodes of several documents that a task remembers.
TOGETHER, REMEMBERED = 1 << 20, 1_000_000


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    for b in batches:
        ids, some, first, size = b.column(0).to_numpy(), [], 0, 0
        for k, t in enumerate(b.column(1).cast(pa.binary())):
            some.append(t.as_py() or b"")
            size += len(some[-1])
            if size >= TOGETHER or k == b.num_rows - 1:
                yield ids[first : k + 1], some
                some, first, size = [], k + 1, 0


def _keys(p: SubstringParams):
    """(key, node): the bands of the nodes of some texts, once for a node, twice where it is in several documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = np.empty(0, np.int64)
        for ids, texts in _together(batches):
            for x in paragraphs(texts, p, True):
                if not len(x.of):
                    continue
                order = np.lexsort((ids[x.of], x.node))
                node, doc = x.node[order], ids[x.of][order]
                starts = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
                many = np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)
                nodes, bands = node[starts], x.bands[order][starts]
                new = ~np.isin(nodes, told)
                told = np.concatenate([told if len(told) < REMEMBERED else told[:0], nodes[many & new]])
                times = np.where(many, 2, 1)[new]
                key, held = np.repeat(bands[new], times, axis=0), np.repeat(nodes[new], times)
                yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(np.repeat(held, key.shape[1]))], ["key", "node"])

    return run


def _spans(p: SubstringParams):
    """All paragraphs; of equal ones that overlap in a document, as in a text of one repeated word, one span."""
    names = ["doc_id", "start", "end", "first", "last", "node"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _together(batches):
            for x in paragraphs(texts, p):
                if not len(x.of):
                    continue
                goes_on = (x.node[1:] == x.node[:-1]) & (x.of[1:] == x.of[:-1]) & (x.first[1:] <= x.last[:-1])
                begin, end = np.flatnonzero(np.concatenate(([True], ~goes_on))), np.flatnonzero(np.concatenate((~goes_on, [True])))
                columns = [x.start[begin], x.end[end], x.first[begin], x.last[end]]
                yield pa.RecordBatch.from_arrays([pa.array(ids[x.of[begin]]), *(pa.array(c.astype(np.int32)) for c in columns), pa.array(x.node[begin])], names)

    return run


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and node, each pair once whose key stands in two rows or more."""
    held = None
    for b in batches:
        key, node = b.column(0).to_numpy(), b.column(1).to_numpy()
        if not len(key):
            continue
        if held is not None:
            key, node = np.concatenate(([held[0]], key)), np.concatenate(([held[1]], node))
        same = key[1:] == key[:-1]
        on = np.concatenate(([held is not None and held[2]], same)) | np.concatenate((same, [False]))
        again = np.concatenate(([held is not None and held[3]], same & (node[1:] == node[:-1])))
        held = (key[-1], node[-1], bool(on[-1]), bool(again[-1]))
        # the last row is held back, as the next may have its key
        out = (on & ~again)[:-1]
        yield pa.RecordBatch.from_arrays([pa.array(key[:-1][out]), pa.array(node[:-1][out])], ["key", "node"])
    if held is not None and held[2] and not held[3]:
        yield pa.RecordBatch.from_arrays([pa.array([held[0]], pa.int64()), pa.array([held[1]], pa.int64())], ["key", "node"])


def _shared(keys: DataFrame, name: str) -> DataFrame:
    return saved(keys.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_shared_keys, "key long, node long"), name)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays without repeats."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    if not len(large):
        return 1.0
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return both / (len(a) + len(b) - both)


#: Sets whose pairs are compared one by one; more are compared through a matrix.
FEW = 6
#: Sets that ask at once, elements that are numbered at once, and cells of a matrix of sets and elements.
ASKING, NUMBERED, CELLS = 512, 1 << 22, 1 << 21


def _shared_elements(sets: list[np.ndarray], part: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(element, set) of the elements of a part that several sets have, numbered from 0 and sorted by number."""
    sets = sets if parts == 1 else [s[s.view(np.uint64) % np.uint64(parts) == part] for s in sets]
    _, element, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    on = (often > 1)[element]
    element, of = (np.cumsum(often > 1) - 1)[element[on]], np.repeat(np.arange(len(sets)), [len(s) for s in sets])[on]
    order = np.argsort(element, kind="stable")
    return element[order], of[order]


def alike(sets: list[np.ndarray], rows: np.ndarray, similarity: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each of the rows (places in the list): its place, and which of all sets have the similarity to it; exact.

    What two sets have in common is counted by products of a matrix of sets and elements, some elements at a time.
    """
    n, size = len(sets), np.fromiter(map(len, sets), np.int64, len(sets))
    width, parts = max(64, CELLS // n), 1 + int(size.sum()) // NUMBERED
    for k in range(0, len(rows), ASKING):
        asking = rows[k : k + ASKING]
        both = np.zeros((len(asking), n))
        for part in range(parts):
            element, of = _shared_elements(sets, part, parts)
            cuts = np.searchsorted(element, np.arange(0, (int(element[-1]) if len(element) else 0) + width + 1, width)).tolist()
            for c, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])):
                held = np.zeros((n, min(width, int(element[j - 1]) - c * width + 1) if j > i else 0), np.float32)  # sums of so few ones are exact
                held[of[i:j], element[i:j] - c * width] = 1
                both += held[asking] @ held.T
        either = size[asking, None] + size[None] - both
        near = np.where(either > 0, both / np.maximum(either, 1), 1.0) >= similarity
        yield from zip(asking.tolist(), near)


def link_block(sets: list[np.ndarray], similarity: float, only: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join all pairs at the similarity or above, through others of the block or not.

    The links go from each set to the first one of its cluster. With `only`, at least one of each pair is marked there.
    """
    n = len(sets)
    label = np.arange(n)
    rows = np.arange(n) if only is None else np.flatnonzero(only)
    if n <= FEW:
        found = ((i, np.array([jaccard(sets[i], x) >= similarity for x in sets], bool)) for i in rows.tolist())
    else:
        found = alike(sets, rows, similarity)
    for i, near in found:
        met = label[near]
        first = min(label[i], met.min(initial=n))
        if (met != first).any() or label[i] != first:
            label[np.isin(label, met) | (label == label[i])] = first
    return [(i, int(label[i])) for i in np.flatnonzero(label != np.arange(n)).tolist()]


def _payload(docs: DataFrame, nodes: DataFrame, p: SubstringParams) -> DataFrame:
    """(node, sh): the shingle set of each node (node, doc_id, first, last: words), from the text it was found in."""
    wanted = nodes.groupBy("doc_id").agg(F.collect_list(F.struct("node", "first", "last")).alias("wanted")).withColumnRenamed("doc_id", "of")
    if nodes.count() <= p.send:
        wanted = F.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, sets = [], []
            want, at = b.column(1).values, b.column(1).offsets.to_numpy()
            node, first, last = (want.field(k).to_numpy() for k in range(3))
            for k, t in enumerate(b.column(0).cast(pa.binary())):
                h = mix(words((t.as_py() or b"").lower())[0])
                mine = slice(at[k], at[k + 1])
                x, y = first[mine].astype(np.int64), last[mine].astype(np.int64)
                inside = y <= len(h)
                sh = shingles(h, p.shingle)
                x, y, want_node = x[inside], y[inside], node[mine][inside]
                ok = range_hashes(h, x, y).view(np.int64) == want_node  # rows that share an id have other texts
                n = p.shingle if len(h) >= p.shingle else 1
                for i, j, of in zip(x[ok].tolist(), y[ok].tolist(), want_node[ok].tolist()):
                    nodes.append(of)
                    sets.append(np.unique(sh[i : max(i + 1, j - n + 1)].view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["node", "sh"])

    return docs.join(wanted, docs["doc_id"] == wanted["of"]).select("text", "wanted").mapInArrow(run, "node long, sh array<long>")


def _compared(rows: DataFrame, p: SubstringParams) -> DataFrame:
    """(a, b) links from (key, block, node, asks, sh); asks: null to compare all, else true for those that are compared with all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nodes, sets, asks = None, [], [], []
        a: list[int] = []
        b: list[int] = []

        def close() -> None:
            if len(nodes) == 2:  # most groups
                links = [(0, 1)] if jaccard(*sets) >= p.similarity else []
            else:
                links = link_block(sets, p.similarity, None if asks and asks[0] is None else np.array(asks, bool))
            a.extend(nodes[i] for i, _ in links)
            b.extend(nodes[j] for _, j in links)

        for batch in batches:
            flat, off = batch.column(4).values.to_numpy(), batch.column(4).offsets.to_numpy()
            for k, (key, block, node, ask) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)))):
                if (key, block) != now:
                    close()
                    now, nodes, sets, asks = (key, block), [], [], []
                elif node == nodes[-1]:
                    continue
                nodes.append(node)
                sets.append(flat[off[k] : off[k + 1]])
                asks.append(ask)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            a.clear()
            b.clear()
        close()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    # a (key, block) holds `block` nodes about and the pivots: a bounded group, read as a run of sorted rows
    dealt = rows.select("key", "block", "node", "asks", "sh").repartition("key", "block").sortWithinPartitions("key", "block", "node")
    return dealt.mapInArrow(run, "a long, b long")


def _sharing_rare(rows: DataFrame, payload: DataFrame, p: SubstringParams) -> DataFrame:
    """(key, node) from (key, node, component): nodes of a key that share one of their rarest shingles there get a key of their own, where these are of two components or more.

    Two sets of a similarity t or more have ceil(t * size) elements in common at least, so in any one order
    of all elements they share one of the first size - ceil(t * size) + 1 of either. Rarest first, few others do.
    """
    sets = rows.join(payload.withColumnRenamed("node", "of"), F.col("node") == F.col("of")).select("key", "node", "component", F.size("sh").alias("size"), F.explode("sh").alias("e"))
    sets = saved(sets, "open-sets")
    often = saved(sets.groupBy(F.col("key").alias("k"), F.col("e").alias("el")).agg(F.count("*").alias("n")).where("n > 1"), "open-shingles")
    counted = sets.join(often, (F.col("key") == F.col("k")) & (F.col("e") == F.col("el")), "left")
    # a node's own shingles; those that no other has are first, and are no keys
    first = counted.groupBy("key", "node", "component", "size").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "e"))).alias("order"))
    need = F.col("size") - F.ceil(F.col("size") * p.similarity - 1e-9) + 1
    each = first.select("key", "node", "component", F.explode(F.slice("order", F.lit(1), need.cast("int"))).alias("x")).where("x.n > 1")
    finer = saved(each.select(F.xxhash64("key", "x.e").alias("key"), "node", "component"), "rare-shingles")
    # what is joined already need not meet again
    unlike = saved(finer.groupBy(F.col("key").alias("of")).agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("of"), "unlike-shingles")
    return finer.join(unlike, F.col("key") == F.col("of")).select("key", "node")


def similar_nodes(buckets: DataFrame, payload: DataFrame, p: SubstringParams, finer: bool = True, known: DataFrame | None = None) -> DataFrame:
    """(node, component) of all nodes that have a link, from (key, node) of shared buckets, each pair once.

    known: links (a, b) that were found before; nodes that they join are not compared again in the end.
    """
    size = saved(buckets.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("who")).where("n > 1"), "bucket-sizes")
    # bands often bring the same nodes together: one bucket of each kind will do
    kinds = saved(size.groupBy("n", "who").agg(F.min("key").alias("of")).select("of", "n"), "bucket-kinds")
    rows = saved(buckets.join(kinds, buckets["key"] == kinds["of"]).drop("of").withColumn("blocks", F.ceil(F.col("n") / p.block).cast("int")), "buckets")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
    big = rows.where("blocks > 1")
    pivots = big.groupBy("key", F.pmod(F.xxhash64("node", F.lit(2)), F.lit(PIVOTS)).alias("pivot")).agg(F.min("node").alias("node"), F.first("blocks").alias("blocks"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    dealt = rows.select("key", "block", "node").unionByName(pivots.select("key", every, "node"))
    with_sets = lambda r: r.join(payload.withColumnRenamed("node", "of"), F.col("node") == F.col("of")).drop("of")
    links = saved(_compared(with_sets(dealt.withColumn("asks", F.lit(None).cast("boolean"))), p), "links")
    found = components(links if known is None else links.unionByName(known))
    before = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    if big.isEmpty():
        return found
    labelled = saved(big.join(found.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").select("key", "block", "blocks", "node", F.coalesce("component", "node").alias("component")), "labelled")
    counts = labelled.groupBy("key", "component").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("parts")).where("parts > 1")
    open_keys = saved(counts.select(F.col("key").alias("of"), "main"), "open-buckets")
    if open_keys.isEmpty():
        return found
    left = labelled.join(open_keys, F.col("key") == F.col("of")).drop("of")
    # those outside the largest cluster ask every block: where blocks are few, and where all share their rarest shingles and are not alike still
    near = left.where(F.col("blocks") <= p.direct) if finer else left
    asking = near.where("component <> main").select("key", every, "node", F.lit(True).alias("asks"))
    asked = near.select("key", "block", "node", F.lit(False).alias("asks"))
    pairs = asked.unionByName(asking).groupBy("key", "block", "node").agg(F.max("asks").alias("asks"))
    told = before.unionByName(saved(_compared(with_sets(pairs), p), "more-links"))
    far = left.where(F.col("blocks") > p.direct).select("key", "node", "component")
    if not finer or far.isEmpty():
        return components(told)
    return similar_nodes(saved(_sharing_rare(far, payload, p), "finer-buckets"), payload, p, False, told)


def _documents(p: SubstringParams, sketch: Callable[[bytes], int] | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, n, bands, fp = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int32), np.zeros((b.num_rows, p.bands), np.int64), np.zeros(b.num_rows, np.uint64)
            for k, t in enumerate(b.column(2).cast(pa.binary())):
                h = mix(words((t.as_py() or b"").lower())[0])
                fp[k] = sketch(t.as_py() or b"") if sketch else 0
                n[k] = len(h)
                if len(h):
                    node[k] = range_hashes(h, np.array([0]), np.array([len(h)])).view(np.int64)[0]
                    bands[k] = band_keys(shingles(h, p.shingle), np.array([0]), p.bands, p.rows)[0]
            some = pa.array(node != 0)
            columns = [pa.array(node), pa.array(fp.view(np.int64)), *(pc.if_else(some, pa.array(np.ascontiguousarray(c)), None) for c in bands.T)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n), *columns], ["row", "doc_id", "n", "node", "fp", *(f"band{k}" for k in range(p.bands))])

    return run


def similar_documents(rows: DataFrame, p: SubstringParams, sketch: Callable[[bytes], int] | None = None, met: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(row, doc_id, component) of (row, doc_id, text): whole texts whose shingle sets have the similarity share a component.

    Texts of equal words are one node, those without words too. sketch, met: an unsigned number of 64 bits for a text, and (key, node)
    from (fp, node), fp being that number; nodes that share such a key are compared besides those that share a band.
    """
    bands = [f"band{k}" for k in range(p.bands)]
    keyed = saved(rows.mapInArrow(_documents(p, sketch), ", ".join(["row long, doc_id long, n int, node long, fp long", *(f"{c} long" for c in bands)])), "documents")
    nodes = saved(keyed.where("band0 is not null").groupBy("node").agg(F.min("row").alias("row"), F.first("n").alias("n"), F.min("fp").alias("fp"), *(F.min(c).alias(c) for c in bands)), "document-nodes")
    keys = nodes.select(F.explode(F.array(*bands)).alias("key"), "node")
    if met is not None:
        keys = keys.unionByName(met(nodes.select("fp", "node")))
    buckets = _shared(keys, "shared-document-bands")
    shared = buckets.select(F.col("node").alias("of")).distinct()
    near = saved(nodes.join(shared, F.col("node") == F.col("of")).select("node", F.col("row").alias("doc_id"), F.lit(0).alias("first"), F.col("n").alias("last")), "near-documents")
    payload = saved(_payload(rows.select(F.col("row").alias("doc_id"), "text"), near, p), "document-shingles")
    found = similar_nodes(buckets, payload, p).withColumnRenamed("node", "of")
    return saved(keyed.join(found, F.col("node") == F.col("of"), "left").select("row", "doc_id", F.coalesce("component", "node").alias("component")), "document-groups")


def repeated_spans(docs: DataFrame, params: SubstringParams = SubstringParams(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, start, end, n_words, component_id, removed), one row per joined span of a document.

    start and end are code points; component_id is the smallest doc_id that holds a copy; removed is
    false for the copy that stays.
    """
    p = params
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null")
    shared = _shared(docs.mapInArrow(_keys(p), "key long, node long"), "shared-bands")
    # nodes that share a band, if only with themselves, and where they stand
    of = shared.select(F.col("node").alias("of")).distinct()
    places = saved(docs.mapInArrow(_spans(p), SPANS).join(saved(of, "shared-nodes"), F.col("node") == F.col("of")).drop("of"), "places")
    nodes = saved(places.groupBy("node").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.min(F.struct("doc_id", "first", "last")).alias("at")), "nodes")
    # those that share a band with others are compared, from the text of one place
    alone = shared.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("key").alias("of"))
    buckets = saved(shared.join(saved(alone, "keys-of-several"), F.col("key") == F.col("of")).select("key", "node"), "buckets-of-several")
    met = saved(buckets.select(F.col("node").alias("of")).distinct(), "met-nodes")
    near = saved(nodes.join(met, F.col("node") == F.col("of")).select("node", "at.*"), "near-places")
    payload = saved(_payload(docs, near, p), "shingle-sets")
    clusters = similar_nodes(buckets, payload, p).withColumnRenamed("node", "of")
    members = saved(nodes.join(clusters, F.col("node") == F.col("of"), "left").select("node", F.coalesce("component", "node").alias("component"), "lo", "hi"), "members")
    reach = saved(members.groupBy("component").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo < hi").select(F.col("component").alias("of"), "lo"), "repeated")
    repeated = saved(members.select("node", "component").join(reach, F.col("component") == F.col("of")).select(F.col("node").alias("of"), "lo"), "repeated-nodes")
    hits = saved(places.join(repeated, F.col("node") == F.col("of")).select("doc_id", "start", "end", "first", "last", "lo"), "hits")
    # a document's spans are bounded by its words
    removed = F.col("lo") < F.col("doc_id")
    by_doc = hits.withColumn("removed", removed)
    islands = by_doc.selectExpr("*", "case when first > coalesce(max(last) over (partition by doc_id, removed order by first, last rows between unbounded preceding and 1 preceding), -1) then 1 else 0 end as opens")
    numbered = islands.selectExpr("*", "sum(opens) over (partition by doc_id, removed order by first, last rows unbounded preceding) as island")
    joined = numbered.groupBy("doc_id", "removed", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), (F.max("last") - F.min("first")).cast("long").alias("n_words"), F.min("lo").alias("component_id"))
    long = joined.where(F.col("n_words") >= p.min_words)
    # a text that stays as part of one that goes is no span of its own
    gone = long.selectExpr("*", "max(case when removed then end end) over (partition by doc_id order by start, removed desc, end desc rows unbounded preceding) as gone")
    return gone.where("removed or gone is null or gone < end").select("doc_id", "start", "end", "n_words", "component_id", "removed")


def remove_spans(docs: DataFrame, params: SubstringParams = SubstringParams(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs with the removed spans cut out of their texts; documents keep their other columns, whatever these are, and their number.

    Rows that share a doc_id are documents of their own here, in the order in which they are read: each is cut by its own spans.
    Rows with a null doc_id stay as they are.
    """
    rows = numbered(docs, "span-rows")
    body = rows.select("row", F.col("kept_row").getField(doc_id).cast("long").alias("doc_id"), F.col("kept_row").getField(text).alias("text")).where("doc_id is not null")
    ranks = saved(dense_index(body.select("row", "doc_id"), [F.col("doc_id"), F.col("row")], "span-order", "rank").select(F.col("row").alias("of"), "rank"), "span-ranks")
    ranked = saved(body.join(ranks, F.col("row") == F.col("of")).select("row", "rank", "text"), "span-texts")
    spans = repeated_spans(ranked, params, "text", "rank").where("removed").groupBy(F.col("doc_id").alias("of")).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    by_row = saved(spans.join(ranks.select("rank", F.col("of").alias("row_of")), F.col("of") == F.col("rank")).select("row_of", "spans"), "cut-spans")

    @F.pandas_udf("string")
    def cut(t: pd.Series, s: pd.Series) -> pd.Series:
        def one(x: str | None, spans) -> str | None:
            if x is None or spans is None:
                return x
            out, at = [], 0
            for y in spans:
                out.append(x[at : y["start"]])
                at = max(at, y["end"])
            return "".join([*out, x[at:]])

        return pd.Series([one(x, y) for x, y in zip(t, s)], dtype=object)

    joined = rows.join(by_row, F.col("row") == F.col("row_of"), "left").select("kept_row", "spans")
    field = lambda c: F.col("kept_row").getField(c)
    return joined.select(*(cut(field(c), F.col("spans")).alias(c) if c == text else field(c).alias(c) for c in docs.columns))
