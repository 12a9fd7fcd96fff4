"""Collocations, clusters and suffix dedup against brute force and on awkward rows."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomcrawl.llm import clustering, collocation, suffix_dedup, suffix_sort
from loomcrawl.llm.common import n_buckets, numbered_texts, scratch_path

rng = np.random.default_rng(5)

# collocations


def brute_collocations(rows, p):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        read = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for c in ".,;:!?\x0b\x0c\r":
            read = read.replace(c, "\n")
        for piece in read.split("\n"):
            w = [x for x in piece.replace("\t", " ").split(" ") if x]
            n[lang] += len(w)
            for k in range(1, p.max_words + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang in f:
        some = {g: a for g, a in f[lang].items() if len(g) > 1 and a >= p.min_count}
        rows = []
        for g, a in some.items():
            if any(len(b) > len(g) and 100 * x >= 100 * a and any(b[i : i + len(g)] == g for i in range(len(b))) for b, x in some.items()):
                continue
            score, k = min((1000 * a * n[lang] // (f[lang][g[:k]] * f[lang][g[k:]]), k) for k in range(1, len(g)))
            rows.append((score, a, " ".join(g), f[lang][g[:k]], f[lang][g[k:]]))
        rows.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i, g, a, x, y, n[lang], s) for i, (s, a, g, x, y) in enumerate(rows[: p.top], 1)]
    return sorted(out)


def spoken(n):
    words = rng.choice([*"abcdefgh", "É", "é", "ß", "Aa", "the"], n, p=[0.3, 0.2, 0.1, *[0.04] * 10])
    return "".join(w + str(rng.choice([" ", "\t", ".", "  ", "\n", " ", " ", ", "])) for w in words)


TALK = [(spoken(200), str(rng.choice(["en", "fr"]))) for _ in range(60)] + [("", "en"), (None, "en"), (" \t.,", "fr"), ("a b c d e f " * 40, None), ("x y", "und"), ("A b c a B", None)] + [("one two three", "de")] * 12


@pytest.mark.parametrize("bits", [1 << 20, 64, 0])
def test_collocations(spark, bits):
    p = collocation.CollocationParams(min_count=11, top=40, filter_bits=bits, salts=3)
    docs = spark.createDataFrame([(t, l, 1, "x") for t, l in TALK], "text string, lang string, a int, phrase string").repartition(3)
    got = sorted(tuple(r) for r in collocation.collocations(docs, p).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    want = brute_collocations(TALK, p)
    assert len(want) > 60 and got == want
    assert ("de", 1, "one two three", 12, 12, 12, 36, 3000) in got  # ties among cuts: the first


def test_long_texts_are_cut_between_pieces(spark, monkeypatch):
    text = ("a b. " * 30 + "c d e") * 20
    want = collocation.collocations(spark.createDataFrame([(text, "en")], "text string, lang string")).collect()
    parts = list(collocation._parts(["en"], iter([text.encode() * 10])))
    assert len(parts) == 1 and want
    monkeypatch.setattr(collocation, "TOGETHER", 100)
    cut = list(collocation._parts(["en", "en"], iter([text.encode(), b"xy " * 100])))
    assert len(cut) > 20 and b"".join(x for _, x in cut).replace(b"\n", b"") == (text + "xy " * 100).replace(".", "").encode()


def test_collocations_of_nothing(spark):
    none = spark.createDataFrame([], "text string, lang string")
    assert collocation.collocations(none).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert collocation.collocations(none).count() == 0


# clusters


def brute_clusters(rows, p):
    kept = [(i, [math.floor(p.scale * float(v)) for v in x]) for i, x in rows if x is not None and len(x) == p.dims and all(v is not None and math.isfinite(v) for v in x)]
    kept.sort(key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    c = [x for _, x in kept[: p.k]]
    apart = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))
    near = lambda x: min((apart(x, y), k) for k, y in enumerate(c))
    for _ in range(p.rounds):
        of = defaultdict(list)
        for _, x in kept:
            of[near(x)[1]].append(x)
        c = [[sum(v) // len(of[k]) for v in zip(*of[k])] if k in of else y for k, y in enumerate(c)]
    found = [(i, *near(x)[::-1]) for i, x in kept]
    whole, by = sum(d for _, _, d in found), Counter()
    for _, k, d in found:
        by[k] += d
    sha = [hashlib.sha256(",".join(map(str, y)).encode()).hexdigest() for y in c]
    return sorted(((i, k, d, by[k], whole, sha[k]) for i, k, d in found), key=str)


def clusters(spark, rows, p, parts=3):
    df = spark.createDataFrame([(i, x, 7) for i, x in rows], "vec_id long, embedding array<double>, cluster int").repartition(parts)
    return sorted((tuple(r) for r in clustering.cluster_vectors(df, p).collect()), key=str)


def test_clusters(spark):
    p = clustering.ClusterParams(k=5, dims=3, tree=64, leaf=4)
    middles = rng.normal(0, 20, (6, 3))
    rows = [(i, (middles[i % 6] + rng.normal(0, 1, 3)).round(2).tolist()) for i in range(500)]
    rows += [(i, [1.5, -2.0, 0.1]) for i in range(500, 650)]  # many equal vectors
    rows += [(7, rows[7][1]), (None, [1.0, 2.0, 3.0]), (901, None), (902, []), (903, [1.0, None, 2.0]), (904, [1.0, float("nan"), 0.0]), (905, [float("inf"), 0.0, 0.0]), (906, [0.0] * 4)]
    want = brute_clusters(rows, p)
    assert len(want) == 652 and clusters(spark, rows, p) == want == clusters(spark, rows, p, 1)


def test_equal_distances_go_to_the_smaller_number(spark):
    p = clustering.ClusterParams(k=4, dims=2, scale=1, tree=16, leaf=2)
    rows = [(i, [float(i % 5), float(i // 5 % 5)]) for i in range(75)]
    assert clusters(spark, rows, p) == brute_clusters(rows, p)


def test_few_none_and_huge_vectors(spark):
    p = clustering.ClusterParams(k=3, dims=2)
    assert clusters(spark, [], p) == []
    assert clusters(spark, [(1, [0.5, -0.26])], p) == brute_clusters([(1, [0.5, -0.26])], p)
    rows = [(i, [3e6 * i, -1e6]) for i in range(4)]  # beyond what 64-bit squares are trusted with
    assert clusters(spark, rows, p) == brute_clusters(rows, p)
    got = clusters(spark, [(i, [1e20 * i, 0.0]) for i in range(4)], p)
    assert len(got) == 4 and any(r[2] is None for r in got) and all(r[4] is None for r in got)


def test_whole_balls_are_assigned():
    points = np.floor(np.concatenate([rng.normal(m, 1, (300, 4)) for m in (0, 1000)]))
    tree, order = clustering.BallTree.build(points, 8)
    assert (tree.points == points[order]).all() and (tree.sums(points[order].astype(np.int64))[0] == points.sum(axis=0)).all()
    balls = list(tree.filtered([[0] * 4, [1000] * 4]))
    assert sum(tree.end[i] - tree.start[i] for i, _ in balls) == 600 and any(len(left) == 1 and tree.end[i] - tree.start[i] >= 300 for i, left in balls)
    assert all((((points[order][tree.start[i] : tree.end[i]] - tree.centre[i]) ** 2).sum(axis=1) <= tree.radius[i] ** 2 * (1 + 1e-9)).all() for i in range(len(tree.start)))


# suffixes


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.binary(min_size=40, max_size=40).map(lambda b: bytes(x & 1 for x in b))), min_size=1, max_size=80), st.sampled_from([0, 8, 24, 40]))
def test_deep_shallow_sorting(rows, shallow):
    rows = rows + rows[: len(rows) // 3]
    group, s = np.array([g for g, _ in rows]), np.array([list(b) for _, b in rows], np.uint8)
    order = suffix_sort.deep_shallow(s, group, shallow)
    assert sorted(order.tolist()) == list(range(len(rows))) and [rows[i] for i in order] == sorted(rows)
    shared = suffix_sort.shared_with_previous(s, group, order)
    for k, (i, j) in enumerate(zip(order[:-1], order[1:]), 1):
        want = -1 if rows[i][0] != rows[j][0] else next((n for n in range(40) if rows[i][1][n] != rows[j][1][n]), 40)
        assert shared[k] == want == (-1 if want < 0 else suffix_sort.common_prefix(rows[i][1], rows[j][1]))


def brute_removed(rows, span):
    seen, out = set(), []
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, k)):
        text = (rows[k][1] or "").encode()
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - span + 1):
            if (s := text[i : i + span]) in seen:
                gone[i : i + span] = True
            seen.add(s)
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((rows[k][0], len(text), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(text, np.uint8)[~gone])).hexdigest()))
    return sorted(out, key=str)


def letters(n, of="abcdefghij klmnop éß世"):
    return "".join(rng.choice(list(of), n))


PASSAGES = [letters(n) for n in (101, 150, 400, 99, 130)]
LONG = letters(5000)
BYTES = (
    [(int(rng.integers(0, 400)) + 10_000 * i, letters(int(rng.integers(0, 150))) + PASSAGES[i % 5] + letters(int(rng.integers(0, 150)))) for i in range(60)]
    + [(i, PASSAGES[2]) for i in range(500, 530)]
    + [(3, None), (4, ""), (5, "x" * 99), (6, "x" * 100), (7, "x" * 1000), (8, "ab" * 700), (None, PASSAGES[1] + "tail"), (None, PASSAGES[1]), (9, LONG), (9, LONG[:2000] + "é" + LONG[2000:]), (10, LONG[100:4000] + LONG[300:4500])]
    + [(20, PASSAGES[4] + letters(50) + PASSAGES[4])]
)


def removed(spark, rows, p, parts=4):
    docs = spark.createDataFrame([(i, t, k, "x") for k, (i, t) in enumerate(rows)], "doc_id long, text string, row int, block string").coalesce(1)
    docs = docs.repartitionByRange(parts, "row") if parts > 1 else docs
    return sorted((tuple(r) for r in suffix_dedup.repeat_report(docs, p).collect()), key=str)


@pytest.mark.parametrize("p", [suffix_dedup.SuffixParams(), suffix_dedup.SuffixParams(block=3), suffix_dedup.SuffixParams(filter_bits=64), suffix_dedup.SuffixParams(span=30, key=12, shallow=8)], ids=["usual", "hot anchors as rows", "full filter", "short"])
def test_repeated_bytes(spark, p):
    want = brute_removed(BYTES, p.span)
    assert sum(r[2] for r in want) > 10_000
    assert removed(spark, BYTES, p) == want == removed(spark, BYTES, p, 1)


def test_no_text_has_nothing_to_remove(spark):
    assert removed(spark, [], suffix_dedup.SuffixParams(), 1) == []
    none = hashlib.sha256(b"").hexdigest()
    assert removed(spark, [(1, None), (1, ""), (None, None)], suffix_dedup.SuffixParams(), 1) == [(1, 0, 0, 0, none), (1, 0, 0, 0, none), (None, 0, 0, 0, none)]


def test_runs_and_what_stays(spark):
    docs = spark.createDataFrame([(1, "x" + PASSAGES[0]), (2, "head " + PASSAGES[0] + " tail")], "doc_id long, text string")
    (r,) = suffix_dedup.remove_repeats(docs).where("doc_id = 2").collect()
    assert [tuple(x) for x in r.removed] == [(5, 5 + len(PASSAGES[0].encode()))] and bytes(r.kept) == b"head  tail"


def test_long_texts_are_read_in_parts(monkeypatch):
    p = suffix_dedup.SuffixParams(span=30, key=12)
    texts = [t.encode() for t in (LONG[:900], letters(20), LONG[:2500] + LONG[300:2900], letters(700), "x" * 500, "")]

    def found():
        size = np.array([len(t) for t in texts])
        out = set()
        for x in suffix_dedup.text_anchors(texts, p):
            text = np.array(x.some)[x.of]
            out |= set(zip(text.tolist(), x.at.tolist(), x.h.tolist(), suffix_dedup.context_hash(x, size[text], p).tolist()))
        return out

    whole = found()
    for k in (40, 100, 1000):
        monkeypatch.setattr(suffix_dedup, "TOGETHER", k)
        assert found() == whole and len(whole) > 400


# tables of numbered rows


def test_tasks_grow_with_the_input(spark):
    rows = spark.range(4000).selectExpr("id as doc_id", "repeat(sha2(cast(id as string), 512), 4) as text")
    paths = {n: scratch_path(spark, f"grow-{n}") for n in (1000, 4000)}
    for n, path in paths.items():
        rows.where(f"doc_id < {n}").write.parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        few, many = (spark.read.parquet(paths[n]) for n in (1000, 4000))
        assert n_buckets(many) >= 3 * n_buckets(few) > 3
        told = numbered_texts(many, "grow", {"doc_id": many["doc_id"], "text": many["text"]}, 6)
        assert told.groupBy("block").count().rdd.getNumPartitions() == n_buckets(many)  # read by buckets, whatever shuffle.partitions is
        spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "2")
        assert n_buckets(many) == 2
        assert told.selectExpr("count(distinct row)", "max(row >> 6 <> block)").first() == (4000, False)
        assert told.groupBy("block").count().selectExpr("max(count)").first()[0] <= 64
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.sources.bucketing.maxBuckets")


def test_blocks_end_by_bytes(spark, monkeypatch):
    monkeypatch.setattr("loomcrawl.llm.common.BLOCK_BYTES", 1000)
    docs = spark.createDataFrame([("a" * n,) for n in (400, 500, 300, 5000, 1, 1, 998, 1)] + [(None,), ("",)], "text string").coalesce(1)
    got = numbered_texts(docs, "bytes", {"text": docs["text"]}, 13).orderBy("row").collect()
    assert [r.block for r in got] == [0, 0, 1, 2, 3, 3, 3, 4, 4, 4]
