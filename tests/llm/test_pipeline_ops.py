"""SimHash, mixing, packing, exact dedup and quality against brute force and on awkward rows."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loomcrawl.llm import components, exact_dedup, mixing, packing, quality, simhash, substring
from loomcrawl.llm.registry import tokenizer_file

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, sha string, size long, component_id long"
BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen " * 6


def rows():
    words = BASE.split()
    near = [" ".join([*words[:k], "zz", *words[k + 1 :]]) for k in (3, 40, 77)]
    texts = [BASE, BASE, BASE.upper(), *near, "", None, " \n ", "ÀB x", "àb x", "ÀB X", "a", "b c", "A", "same", "same", "long " * 3000 + "tail"]
    out = [(i, t, "en", f"s{i % 3}" if i % 5 else None, 1, "clash", 7, 9) for i, t in enumerate(texts)]
    return [*out, out[1], (None, BASE, "en", "s0", 1, "clash", 7, 9), (100, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def low(t):
    return (t or "").encode().lower().decode()


def test_exact_groups(docs):
    got = sorted(map(tuple, exact_dedup.exact_groups(docs).collect()), key=repr)
    group = defaultdict(list)
    for r in rows():
        group[low(r[1])].append(r[0])
    assert len(got) == len(rows())
    for doc_id, keep, size, kept, sha in got:
        (t,) = [t for t in group if hashlib.sha256(t.encode()).hexdigest() == sha]
        assert doc_id in group[t] and size == len(group[t]) and keep == max((x for x in group[t] if x is not None), default=None)
        assert not kept or doc_id == keep
    assert Counter(g[4] for g in got if g[3]) == Counter(hashlib.sha256(t.encode()).hexdigest() for t in group)


def test_drop_exact_duplicates(docs):
    got = exact_dedup.drop_exact_duplicates(docs)
    assert got.columns == docs.columns
    best = {}
    for r in rows():
        best[low(r[1])] = max(best.get(low(r[1]), -1), -1 if r[0] is None else r[0])
    assert sorted((r.doc_id, low(r.text)) for r in got.collect()) == sorted((i, t) for t, i in best.items())


def test_no_text_is_shuffled_where_nothing_is_broadcast(spark, docs, capsys):
    want = sorted(map(repr, exact_dedup.drop_exact_duplicates(docs).collect())), sorted(map(repr, exact_dedup.exact_groups(docs).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = exact_dedup.drop_exact_duplicates(docs.withColumn("attributes", F.create_map(F.lit("a"), F.lit(1))))
        assert sorted(map(repr, got.drop("attributes").collect())) == want[0]
        got.explain("formatted")
        nodes = [n.split("\n\n")[0] for n in capsys.readouterr().out.split("\n(")[1:]]
        moved = [n for n in nodes if "Exchange" in n.split("\n")[0] and "Input" in n]
        assert moved and not any("kept_row" in n or "text" in n for n in moved)
        assert sorted(map(repr, exact_dedup.exact_groups(docs).collect())) == want[1]
        near = simhash.drop_near_duplicates(docs)
        near.explain("formatted")
        assert not any("kept_row" in n for n in capsys.readouterr().out.split("\n(")[1:] if "Exchange" in n.split("\n")[0])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def brute_fingerprint(text):
    w = low(text).encode().split()
    if not w:
        return 0
    sh = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def test_simhash(docs):
    got = simhash.simhash_report(docs).collect()
    assert Counter((r.doc_id, r.fingerprint) for r in got) == Counter((r[0], f"{brute_fingerprint(r[1]):016x}") for r in rows())
    prints = [(r[0], brute_fingerprint(r[1])) for r in rows() if r[0] is not None]
    label = {i: i for i, _ in prints}
    for _ in prints:
        for i, a in prints:
            for j, b in prints:
                if (a ^ b).bit_count() <= 2:
                    label[i] = label[j] = min(label[i], label[j])
    assert all(r.component_id == label[r.doc_id] for r in got if r.doc_id is not None)


def test_near_duplicates_are_dropped_by_row(spark):
    words = [f"v{i}" for i in range(400)]
    other, third = " ".join(reversed(words)), " ".join(words[::3] * 2)
    texts = [(5, BASE), (None, BASE + "\n"), (None, other), (7, third), (7, BASE + " "), (None, "x y z"), (None, "x  y z")]
    got = simhash.drop_near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, " ".join(r.text.split())) for r in got) == Counter([(5, " ".join(BASE.split())), (None, other), (7, third), (None, "x y z")])


def test_near_copies_meet_at_anchors(spark):
    rng = np.random.default_rng(6)
    rows, near = [], set()
    for i in range(40):
        w = [f"u{x}" for x in rng.integers(0, 3000, 400)]
        rows.append((2 * i, " ".join(w)))
        w[200] = "edit"
        rows.append((2 * i + 1, " ".join(w)))
        if (simhash.fingerprint(rows[-1][1].encode(), 5) ^ simhash.fingerprint(rows[-2][1].encode(), 5)).bit_count() <= simhash.THRESHOLD:
            near.add(2 * i + 1)
    params = substring.SubstringParams(bands=1, rows=400)  # a band that almost no pair shares
    kept = {r.doc_id for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), params=params).collect()}
    assert len(near) > 10 and not near & kept and {2 * i for i in range(40)} <= kept


def test_near_copies_at_jaccard_are_dropped(spark):
    rng = np.random.default_rng(5)
    rows, sets = [], {}
    for i in range(120):
        w = [f"u{x}" for x in rng.integers(0, 3000, 100)]
        rows.append((2 * i, " ".join(w)))
        for p in rng.choice(100, int(rng.integers(1, 7)), replace=False):
            w[p] = "edit"
        rows.append((2 * i + 1, " ".join(w).upper()))
    for i, t in rows:
        w = t.lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(96)}
    near = {i for i in range(1, 240, 2) if len(sets[i] & sets[i - 1]) / len(sets[i] | sets[i - 1]) >= 0.8}
    got = {r.doc_id for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    gone = set(sets) - got
    assert 20 < len(near) < 100 and gone <= near and len(gone) >= 0.97 * len(near)
    prints = {i: simhash.fingerprint(t.encode()) for i, t in rows}
    assert sum((prints[i] ^ prints[i - 1]).bit_count() <= 2 for i in near) < len(near) / 2


def test_null_ids_bridge_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(simhash, "_fingerprints", lambda batches: (b.select([0]).append_column("fp", b.column(1).cast("int64")) for b in batches))
    rows = [(3, "0"), (None, "3"), (9, "15"), (None, str(1 << 40 | 1 << 50 | 1 << 60))]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.fp, r.component_id or -1) for r in got) == [(0, 3), (3, 3), (15, 3), (int(rows[3][1]), -1)]


def test_anchors_meet_all_pairs_within_two():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 64, 300, np.uint64)
    y = x.copy()
    for flips in (1, 2):
        for k in range(flips):
            y ^= np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)
        a, b = defaultdict(set), defaultdict(set)
        for to, points in ((a, x), (b, y)):
            for i, anchor in zip(*simhash.anchors_within_2(points)):
                to[i].add(int(anchor))
                assert (int(anchor) ^ int(points[i]) & (1 << 63) - 1).bit_count() <= 2
        assert all(a[i] & b[i] for i in range(300) if (int(x[i]) ^ int(y[i])).bit_count() <= 2)
    assert not simhash.syndrome(np.array([int(v) for v in a[0]], np.uint64)).any()


def test_link_group_finds_every_cluster():
    fp = np.array([0, 1, 3, 7, 15, 1 << 40, 0xFFFF << 20], np.uint64)
    links = simhash.link_group(fp, np.arange(10, 17))
    root = {i: i for i in range(10, 17)}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert root == {10: 10, 11: 10, 12: 10, 13: 10, 14: 10, 15: 10, 16: 16}  # 0 and 1 << 40 differ in one bit


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 200, (120, 2))] + [(i, i + 1) for i in range(300, 360)] + [(500, 500), (None, 3)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e if x is not None}
    for _ in range(70):
        for a, b in edges:
            if a is not None and b is not None:
                label[a] = label[b] = min(label[a], label[b])
    assert got == {x: v for x, v in label.items() if any(x in e and e[0] != e[1] and None not in e for e in edges)}


def test_mixing(docs):
    got = mixing.mix_report(docs).collect()
    size = Counter()
    for r in rows():
        size[r[3]] += len((r[1] or "").split())
    weight = {s: 1 + i % 3 for i, s in enumerate(sorted(size, key=lambda s: (s is None, s or "")))}
    target, capped = {}, set()
    while True:
        left = sum(size.values()) - sum(3 * size[s] for s in capped)
        target = {s: 3 * size[s] if s in capped else left * weight[s] / sum(w for t, w in weight.items() if t not in capped) for s in size}
        if not (new := {s for s in size if target[s] > 3 * size[s]}):
            break
        capped |= new
    text = {r[0]: r for r in rows()}
    for r in got:
        assert r.target == pytest.approx(target[text[r.doc_id][3]]) and r.source_size == size[text[r.doc_id][3]]
        assert r.size == len((text[r.doc_id][1] or "").split()) and r.taken == r.size * r.copies <= 3 * r.size
    out = Counter(r.doc_id for r in mixing.mix_documents(docs).collect())
    want = Counter()
    for r in got:
        want[r.doc_id] += r.copies
    assert out == +want


def test_mixing_comes_near_its_targets(spark):
    many = [(i, "w " * (1 + i * 7919 % 50), "abcd"[min(3, i % 9)]) for i in range(4000)]
    got = mixing.mix_report(spark.createDataFrame(many, "doc_id long, text string, source string")).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r.source_size, r.target] += r.taken
    assert len(taken) == 4 and all(abs(v - t) < 0.06 * t for (_, t), v in taken.items())


def test_plan_runs_hold_all_pieces():
    rng = np.random.default_rng(3)
    for capacity, high in ((2048, 2048), (30, 30), (30, 9), (30, 20)):
        counts = Counter(rng.integers(1, high + 1, 3000).tolist())
        runs = packing.plan_runs(counts, capacity)
        held = Counter()
        for r in runs:
            assert sum(n * each for n, each in r.parts) == capacity - r.gap <= capacity
            assert sum(each for n, each in r.parts if 3 * n > capacity) <= 2
            for n, each in r.parts:
                held[n] += r.bins * each
        assert held == counts
        least = max(-(-sum(k * v for k, v in counts.items()) // capacity), sum(v for k, v in counts.items() if 2 * k > capacity))
        assert sum(r.bins for r in runs) <= 1.03 * least + 1
    assert packing.plan_runs({}, 30) == []


def test_packing(docs):
    params = packing.PackParams(tokenizer_file("word_bpe_49k.json"))
    got = packing.pack(docs, params).collect()
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(params.tokenizer)
    want, n = Counter(), 0
    for r in rows():
        ids = [*tok.encode(r[1] or "", add_special_tokens=False).ids, 0]
        for k, s in enumerate(range(0, len(ids), 2048)):
            want[r[0], k, s, tuple(ids[s : s + 2048])] += 1
            n += 1
    assert Counter((r.doc_id, r.piece, r.start, tuple(packing.unpack_ids(r.ids).tolist())) for r in got) == want and len(got) == n
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    crc = {(r.doc_id, r.piece): r.ids_crc32 for r in packing.pack_report(docs, params).collect()}
    assert all(crc[r.doc_id, r.piece] == zlib.crc32(packing.unpack_ids(r.ids).tobytes()) for r in got)
    assert sum(len(r.pieces) for r in packing.sequences(packing.pack(docs, params)).collect()) == n


def thue_morse(n, a, b):
    return "".join(b if i.bit_count() % 2 else a for i in range(n))


@pytest.mark.parametrize("name,kind", [("byte_bpe_50k.json", "spaces"), ("word_bpe_49k.json", "words")])
def test_words_encode_like_whole_texts(name, kind):
    from tokenizers import Tokenizer

    from loomcrawl.llm.tokens import WordEncoder

    untouched = Tokenizer.from_file(tokenizer_file(name))
    texts = ["a b", " a", "a ", "a  b", "it's 'tis\nwe'll\n\nx", "tab\tb  c", "é ́x", "12 345,6 !?", "\x1c a\x1cb", "ÀÉ ß ﬁ İ Σς", "", None, "\n", "日本 語", "a\r\nb c", "\xa0a \xa0\xa0b\xa0", "x\u2003 y", "a\n\xa0\xa0b", "\u2028", " ", "Kelvin \u212a \u212b"]
    texts += ["<|endoftext|>", "one <|endoftext|> two", "x<|endoftext|>y  z\n", "<|ENDOFTEXT|> w", "<|startoftext|>a b<|endoftext|>", "\xa0 <|endoftext|>", "a <|endoftext |>", "<|endoftext|> x"]
    texts += [f"{thue_morse(1024, 'a', 'b')} {thue_morse(1024, 'b', 'a')}", thue_morse(1024, "b", "a"), thue_morse(1024, "a", "b")]
    rng = np.random.default_rng(5)
    points = [*range(32, 127), *range(160, 1000), 9, 10, 13, 0x1C, 0x85, 0x2003, 0x3000, 0x4E2D, 0x6587, 0x1F600, 0x0301, 0x200D]
    texts += ["".join(map(chr, rng.choice(points, int(n)))) for n in rng.integers(1, 200, 300)]
    want = [untouched.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in WordEncoder(tokenizer_file(name), kind).encode(texts)] == want
    assert untouched.token_to_id("<|endoftext|>") in untouched.encode("one <|endoftext|> two", add_special_tokens=False).ids


@pytest.mark.parametrize("name,kind", [("byte_bpe_50k.json", "spaces"), ("word_bpe_49k.json", "words")])
def test_words_of_equal_hash_keep_their_own_ids(name, kind, monkeypatch):
    from tokenizers import Tokenizer

    from loomcrawl.llm import tokens

    found = tokens.words
    monkeypatch.setattr(tokens, "words", lambda text: (lambda h, s, e: (h & np.uint64(7), s, e))(*found(text)))
    texts = ["the quiet river walks by stone", "stone walks a river", "harbours, evenings; words and words", "a\nb c"] * 3
    untouched = Tokenizer.from_file(tokenizer_file(name))
    enc = tokens.WordEncoder(tokenizer_file(name), kind)
    for some in (texts, texts[::-1], ["unseen yet"]):
        assert [x.tolist() for x in enc.encode(some)] == [untouched.encode(t, add_special_tokens=False).ids for t in some]


def test_packing_query_keeps_special_tokens(spark, tmp_path):
    from loomcrawl.llm import registry

    spark.createDataFrame([(1, "one <|endoftext|> two")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert [r.length for r in registry.op7_packing(spark, str(tmp_path)).collect()] == [4]


def brute_base(text):
    w = (text or "").encode().split()
    win = Counter(zip(w, w[1:], w[2:]))
    rep = {j for i in range(len(w) - 2) if win[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for x in (text or "").split("\n"):
        if x.encode().split():
            dup += x in seen
            seen.add(x)
    return len(w), sum(len(x.decode()) for x in w), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(rep)


def test_base_counts():
    for t in ["", None, "a", "a a", "a a a", "a a a a", "a b c a b c", "é ü x # $\n\n \nq\nq\nq ", "x y z " * 40 + "tail", "a|b<c>\r\na|b<c>\r\n"]:
        assert quality.base_counts((t or "").encode()) == brute_base(t)


def test_quality(spark):
    rng = np.random.default_rng(4)
    good = lambda: " ".join(rng.choice(["river", "stone", "walks", "quiet", "the", "of", "harbour", "evening"], 80))
    bad = lambda: " ".join(x + "!!" for x in rng.choice(["BUY", "NOW", "CHEAP", "WIN", "PRIZE", "CLICK"], 80))
    texts = [(i, good() if i % 3 else bad(), 1 if i % 3 else 0) for i in range(240)]
    docs = spark.createDataFrame([(i, t, "extra") for i, t, _ in texts] + [(900, None, "x"), (901, "too short", "x")], "doc_id long, text string, probability string")
    labels = spark.createDataFrame([(i, q) for i, _, q in texts[:180]] + [(None, 1), (5, None)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.quality_report(docs, labels).collect()}
    for i, t, q in texts[180:]:
        assert got[i].base_failed == (100 * got[i].n_repeat_words > 50 * got[i].n_words)
        assert got[i].kept == (bool(q) and not got[i].base_failed)
    assert got[900].n_words == 0 and got[900].base_failed and not got[900].kept and not got[901].kept
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}
    model = quality.fit(docs, labels)
    long = (texts[1][1] + " ") * 4000
    assert quality.score(long.encode(), model) == pytest.approx(quality.score(((texts[1][1] + " ") * 40).encode(), model), abs=0.05)
    none = quality.quality_report(docs, labels.where("quality = 1")).collect()
    assert all(r.probability is None and r.kept == (not r.base_failed) for r in none)


def test_ngrams_are_of_whole_code_points(monkeypatch):
    p = quality.QualityParams()
    text = "Straße élan 日本語 x " * 9 + "word" * 30
    for part in (1 << 20, 7):
        monkeypatch.setattr(quality, "_PART", part)
        got = {k: Counter(np.concatenate([g for j, g in quality.ngrams(text.encode(), p) if j == k]).tolist()) for k in (0, 1)}
        assert got[1].total() == len(text) - 3 and got[0].total() == 2 * len(text.split()) - 1
        assert sorted(got[1].values()) == sorted(Counter(text[i : i + 4] for i in range(len(text) - 3)).values())
        w = text.split()
        assert sorted(got[0].values()) == sorted((Counter(w) + Counter(zip(w, w[1:]))).values())
    assert not any(len(g) for _, g in quality.ngrams(b"", p))


def test_a_labelled_id_counts_once(spark):
    docs = spark.createDataFrame([(i % 40, f"word{i % 2} " * 60) for i in range(4000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    once = quality.fit(docs.dropDuplicates(["doc_id", "text"]), labels)
    many = quality.fit(docs, labels)
    assert np.array_equal(np.sort(once.weights), np.sort(many.weights)) and once.slope == pytest.approx(many.slope)


def test_empty(spark, docs):
    empty, labels = docs.limit(0), spark.createDataFrame([], "doc_id long, quality int")
    assert exact_dedup.exact_groups(empty).count() == 0 and exact_dedup.drop_exact_duplicates(empty).count() == 0
    assert simhash.simhash_report(empty).count() == 0 and simhash.drop_near_duplicates(empty).count() == 0
    assert mixing.mix_report(empty).count() == 0 and mixing.mix_documents(empty).count() == 0
    assert packing.pack(empty, packing.PackParams(tokenizer_file("word_bpe_49k.json"))).count() == 0
    assert quality.quality_report(empty, labels).count() == 0
