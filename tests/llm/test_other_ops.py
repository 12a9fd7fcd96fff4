"""Substring dedup, pseudo-likelihood, HTML text, records and sharding against brute force and on awkward rows."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from loomcrawl.llm import hashing, html_text, pseudo_likelihood as lm, records, sharding, substring
from loomcrawl.llm.common import scratch_path
from loomcrawl.llm.packing import unpack_ids
from loomcrawl.llm.registry import tokenizer_file

rng = np.random.default_rng(11)
VOCAB = [f"w{i}" for i in range(4000)]


def prose(n):
    return " ".join(rng.choice(VOCAB, n))


def edited(text, *places):
    w = text.split()
    for p in places:
        w[p] = "edit"
    return " ".join(w)


# substring dedup

PASSAGE, LINE, SHORT = prose(56), prose(70), prose(12)
SUB = [
    (1, f"{prose(30)} {PASSAGE} {prose(40)}", "x"),
    (2, f"{prose(60)} {PASSAGE.upper()} {prose(11)}", "x"),
    (3, f"{prose(25)}\n{LINE}\n{SHORT}", "x"),
    (4, f"é {prose(25)}\n{edited(LINE, 30)}\n{SHORT}", "x"),
    (5, f"{prose(90)}\n{SHORT}", "x"),
    (6, None, "x"),
    (7, "", "x"),
    (8, f"{prose(30)}\n{(inner := prose(40))}\n{inner}", "x"),
    (None, LINE, "x"),
    (9, f"{prose(22)}\n{edited(LINE, 30, 60)}", "x"),
]


def test_substring(spark):
    docs = spark.createDataFrame(SUB, "doc_id long, text string, bands string")
    text = {i: t for i, t, _ in SUB}
    got = [r for r in substring.repeated_spans(docs).collect()]
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
        assert len(text[r.doc_id][r.start : r.end].split()) == r.n_words
    assert set(by) == {1, 2, 3, 4, 9}
    for doc, lo in ((1, 1), (2, 1), (3, 3), (4, 3), (9, 3)):
        (r,) = by[doc]
        assert r.component_id == lo and r.removed == (doc != lo)
        cut = text[doc][r.start : r.end].lower()
        assert cut in PASSAGE.lower() or cut in text[doc].split("\n") or cut in text[doc]
        assert r.n_words >= (25 if doc < 3 else 70)
    assert text[4][by[4][0].start : by[4][0].end].startswith(edited(LINE, 30))
    left = {r.doc_id: r for r in substring.remove_spans(docs).collect()}
    assert left[1].text == text[1] and left[3].text == text[3] and left[6].text is None and left[None].text == LINE
    assert LINE.split()[0] not in left[4].text.split() and SHORT in left[5].text == text[5]


def test_passages_cross_lines(spark):
    """Verse: every line is short, and a passage of 49 words or more is found wherever it stands."""
    wrapped = lambda t, n: "\n".join(" ".join(t.split()[k : k + n]) for k in range(0, len(t.split()), n))
    shared = [prose(49 + k) for k in range(12)]
    rows = [(k, wrapped(f"{prose(int(rng.integers(0, 60)))} {t} {prose(int(rng.integers(0, 60)))}", 7)) for k, t in enumerate(shared)]
    rows += [(100 + k, wrapped(f"{prose(int(rng.integers(0, 60)))} {t} {prose(int(rng.integers(0, 60)))}", 11)) for k, t in enumerate(shared)]
    rows += [(200, "same " * 4000), (201, "same " * 3000), (202, "a b c " * 500)]
    got = substring.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert set(by) == {*range(12), *range(100, 112), 200, 201}
    for k in range(12):
        assert {r.component_id for r in by[100 + k]} == {k} and all(r.removed for r in by[100 + k])
    assert [(r.start, r.end, r.removed) for r in by[201]] == [(0, 3000 * 5 - 1, True)]


def test_paragraphs_against_all_pairs(spark):
    """Recall over all pairs of lines at 0.8 and of passages at 1, by brute force over shingle sets."""
    p = substring.SubstringParams()
    base = [prose(90) for _ in range(25)]
    copies = [edited(t, *rng.choice(90, int(rng.integers(0, 4)), replace=False)) for t in base for _ in range(4)]
    rows = [(k, "\n".join([prose(int(rng.integers(3, 40))), t, prose(int(rng.integers(3, 40)))])) for k, t in enumerate(rng.permutation(copies).tolist())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    both = substring.paragraphs([t.encode() for _, t in rows], p)
    words = [t.lower().split() for _, t in rows]
    expected = set()
    for x, least in zip(both, (0.8, 1)):
        places = list(zip(x.of.tolist(), x.first.tolist(), x.last.tolist()))
        sets = [{tuple(words[o][k : k + 5]) for k in range(a, b - 4)} for o, a, b in places]
        holds = defaultdict(set)
        for k, one in enumerate(sets):
            for e in one:
                holds[e].add(k)
        label = list(range(len(sets)))

        def find(i):
            while label[i] != i:
                i = label[i]
            return i

        for i, one in enumerate(sets):
            for j in set().union(*(holds[e] for e in one)):
                if j < i and len(one & sets[j]) / len(one | sets[j]) >= least:
                    label[find(i)] = find(j)
        members = defaultdict(set)
        for k, (o, a, b) in enumerate(places):
            members[find(k)].add((o, a, b))
        for m in members.values():
            lo = min(o for o, _, _ in m)
            if len({o for o, _, _ in m}) > 1:
                expected |= {(o, k) for o, a, b in m if o > lo for k in range(a, b)}
    got = {(r.doc_id, k) for r in substring.repeated_spans(docs).where("removed").collect() for k in range(len(rows[r.doc_id][1][: r.start].split()), len(rows[r.doc_id][1][: r.end].split()))}
    assert len(got - expected) == 0 and len(got & expected) >= 0.95 * len(expected)


def brute_components(sets, similarity):
    label = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if len(a | b) == 0 or len(a & b) / len(a | b) >= similarity:
                    label[i] = label[j] = min(label[i], label[j])
    return label


def sets_like_chains(n):
    base, out = list(range(50)), []
    for i in range(n):
        if i % 17 == 0:
            base = [int(x) for x in rng.integers(0, 500, 50)]
        base = list(base)
        base[int(rng.integers(50))] = int(rng.integers(500, 900))
        out.append(set(base))
    return out


def test_link_block_joins_all_that_are_similar():
    for n in (3, 40, 90):
        sets = sets_like_chains(n)
        order = rng.permutation(n)
        mixed = [sets[k] for k in order]
        links = substring.link_block([np.array(sorted(s), np.int64) for s in mixed], 0.8)
        label = list(range(n))
        for _ in range(n):
            for i, j in links:
                label[i] = label[j] = min(label[i], label[j])
        assert label == brute_components(mixed, 0.8) and len(links) == n - len(set(label))


def test_big_buckets_lose_no_link(spark):
    """Blocks of 8 nodes: pivots and the last round must find what one block cannot see."""
    sets = sets_like_chains(120)
    payload = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "node long, sh array<long>")
    buckets = spark.createDataFrame([(7, i) for i in range(120)] + [(8, 0), (8, 1)], "key long, node long")
    want = brute_components(sets, 0.8)
    for finer, direct in ((True, 0), (True, 16), (False, 0)):
        got = {r.node: r.component for r in substring.similar_nodes(buckets, payload, substring.SubstringParams(block=8, direct=direct), finer).collect()}
        assert [got.get(i, i) for i in range(120)] == want


def test_nodes_that_are_not_alike_do_not_meet(spark):
    """One common shingle brings 400 sets together; what they are compared by in the end are rare ones."""
    sets = [{0, *range(1000 * i + 1, 1000 * i + 40)} for i in range(400)]
    sets[7] = sets[3] | {9}
    payload = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "node long, sh array<long>")
    p = substring.SubstringParams(block=8)
    finer = substring._sharing_rare(spark.createDataFrame([(7, i, i) for i in range(400)], "key long, node long, component long"), payload, p).groupBy("key").count().collect()
    assert max(r[1] for r in finer) == 2 and len(finer) <= 18
    got = {r.node: r.component for r in substring.similar_nodes(spark.createDataFrame([(7, i) for i in range(400)], "key long, node long"), payload, p).collect()}
    assert got[7] == got[3]


def test_bands_reach_their_recall():
    p, met, n = substring.SubstringParams(), 0, 0
    for _ in range(150):
        line = prose(60)
        other = edited(line, *rng.choice(60, 1, replace=False))
        a, b = map(set, substring.paragraphs([line.encode(), other.encode()], p, True)[0].bands.tolist())
        n, met = n + 1, met + bool(a & b)
    assert met / n > 0.97
    met = n = 0


def test_spans_do_not_depend_on_their_company():
    p = substring.SubstringParams()
    texts = ["", f"é {prose(30)}\n{prose(5)}\n\n {prose(45)} ", prose(400), " \n", f"{prose(21)} ünd\n{prose(25)}", "x"]
    data = [t.encode() for t in texts]
    both = substring.paragraphs(data, p)
    columns = ("start", "end", "first", "last", "node")
    for which, n in ((0, 5), (1, 20)):
        rows = []
        for i, d in enumerate(data):
            t = substring.paragraphs([d], p)[which]
            rows += [(i, *(getattr(t, c)[k] for c in columns)) for k in range(len(t.of))]
        got = both[which]
        assert rows == [(got.of[k], *(getattr(got, c)[k] for c in columns)) for k in range(len(got.of))]
        assert len(rows) >= n
        for i, start, end, first, last, _ in rows:
            assert texts[i][start:end].split() == texts[i].split()[first:last]
    x = set(substring.paragraphs([f"{prose(25)} {texts[2]}".encode()], p)[1].node.tolist())
    own = set(substring.paragraphs([data[2]], p)[1].node.tolist())
    assert own <= x
    at = substring.paragraphs([data[2]], p)[1].first
    assert np.diff(at).max() <= p.reach and at[0] < p.reach


def test_shared_keys():
    import pyarrow as pa

    key = np.sort(rng.integers(0, 300, 400))
    parts = np.array_split(np.arange(400), 23)
    batches = [pa.RecordBatch.from_arrays([pa.array(key[p]), pa.array(p)], ["key", "node"]) for p in parts]
    got = sorted(n for b in substring._shared_keys(iter(batches)) for n in b.column(1).to_pylist())
    count = Counter(key.tolist())
    assert got == [i for i in range(400) if count[key[i]] > 1]
    node = rng.integers(0, 3, 400)
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    batches = [pa.RecordBatch.from_arrays([pa.array(key[p]), pa.array(node[p])], ["key", "node"]) for p in parts]
    got = [r for b in substring._shared_keys(iter(batches)) for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
    assert sorted(got) == sorted({(k, n) for k, n in zip(key.tolist(), node.tolist()) if count[k] > 1})


def test_word_hashes():
    text = "a é  bb\n\tc\x0b" * 5 + "long" * 9 + " eightlet eightlett " + "x" * 64 + " " + "x" * 65 + " " + "x" * 300
    h, s, e = hashing.words(text.encode())
    assert [text.encode()[a:b] for a, b in zip(s, e)] == text.encode().split()
    by = defaultdict(set)
    for x, w in zip(h.tolist(), text.split()):
        by[w].add(x)
    assert all(len(v) == 1 for v in by.values()) and len(set.union(*by.values())) == len(by)
    old, hashing._PART = hashing._PART, 7
    try:
        again = hashing.words(text.encode())
    finally:
        hashing._PART = old
    assert all(np.array_equal(a, b) for a, b in zip((h, s, e), again))


# pseudo-likelihood


def test_network_gradient_and_scores():
    p = lm.LmParams(classes=5, hashed=4, dim=3, side=2)
    net = lm.Network(p)
    net.flat[:] = rng.normal(0, 0.5, len(net.flat))
    ids = rng.integers(0, 25, 30)
    context = lm.windows(ids, 2)
    padded = [0, 0, *ids.tolist(), 0, 0]
    assert context.tolist() == [[padded[i], padded[i + 1], padded[i + 3], padded[i + 4]] for i in range(30)]
    embed, bias, outer, inner = net.parts
    total = 0.0
    for i, t in enumerate(ids):
        h = np.append(np.tanh(sum(embed[k][context[i, k]] for k in range(4)) + bias), 1)
        soft = lambda z, k: z[k] - np.log(np.exp(z).sum())
        total += soft(h @ outer, t // 5) + soft(h @ inner[t // 5], t % 5)
    assert net.log_probability(context, ids).sum() == pytest.approx(total, rel=1e-5)
    assert np.exp(net.log_probability(np.repeat(context[:1], 25, 0), np.arange(25))).sum() == pytest.approx(1, rel=1e-5)
    back, g_outer, g_inner, g_bias = net.gradient(context, ids)
    for part, grad in ((1, g_bias), (2, g_outer), (3, g_inner)):
        flat, g = net.parts[part].reshape(-1), grad.reshape(-1)
        for k in rng.choice(len(flat), 3):
            was, loss = flat[k], []
            for d in (1e-2, -1e-2):
                flat[k] = was + d
                loss.append(-net.log_probability(context, ids).mean())
            flat[k] = was
            assert (loss[0] - loss[1]) / 2e-2 == pytest.approx(g[k], abs=2e-3)


def test_pseudo_likelihood(spark):
    order = [f"t{i}" for i in range(40)]
    good = [" ".join(order[(s + k) % 40] for k in range(80)) for s in rng.integers(0, 40, 300)]
    rows = [(i, t, 1.0) for i, t in enumerate(good)] + [(900, " ".join(rng.permutation(good[0].split())), 1.0), (901, None, 1.0), (902, " \n", 1.0), (902, good[1], 1.0), (None, "t1", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, log_likelihood double").repartition(3)
    p = lm.LmParams(classes=8, hashed=8, step=128, rounds=3)
    model = lm.fit(docs, p)
    vocab, net = model.vocabulary, model.network
    assert set(vocab.known.tolist()) == set(hashing.mix(hashing.words(" ".join(order).encode())[0]).tolist())
    got = lm.score_documents(docs, p, model=model).collect()
    by = {r.doc_id: r for r in got}
    mean = np.mean([by[i].mean_log_likelihood for i in range(300)])
    assert mean > -1.5 and by[900].mean_log_likelihood < mean - 2
    assert by[901].n_tokens == 0 and by[901].log_likelihood == 0 and by[901].mean_log_likelihood is None
    assert len(got) == len(rows) and by[None].n_tokens == 1
    h = hashing.mix(hashing.words(good[5].encode())[0])
    ids = vocab.ids(h)
    assert by[5].log_likelihood == pytest.approx(float(sum(net.log_probability(lm.windows(ids, 2)[k : k + 1], ids[k : k + 1])[0] for k in range(len(ids)))), rel=1e-4)
    assert lm.score_documents(docs.limit(0), p).count() == 0


def test_every_word_has_its_own_probability(spark):
    common = [f"c{i}" for i in range(24)]
    texts = [" ".join([*rng.choice(common, 30), *(f"rare{rng.integers(400)}" for _ in range(20))]) for _ in range(120)] + ["once " * 3 + "x" * 5000 + " c1" * 40000]
    texts += [" ".join(f"twin{i}" for i in range(60))] * 2 + [" ".join(f"lone{i}" for i in range(60))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    p = lm.LmParams(classes=6, hashed=8, step=128, block=16)
    got = {r.doc_id: r for r in lm.score_documents(docs, p).collect()}
    assert got[121].mean_log_likelihood == pytest.approx(got[122].mean_log_likelihood)
    assert got[121].mean_log_likelihood > got[123].mean_log_likelihood + 1  # its words occur elsewhere
    # against loops over all words
    model = lm.fit(docs, p)
    count = Counter(w for t in texts for w in t.split())
    key = {w: int(hashing.mix(hashing.words(w.encode())[0])[0]) for w in count}
    top = sorted(count, key=lambda w: (-count[w], int(np.uint64(key[w]).astype(np.int64))))[: 36 - 1 - 8]
    assert set(model.vocabulary.known.tolist()) == {key[w] for w in top}
    share = defaultdict(list)
    for w in count:
        if w not in top:
            share[1 + (key[w] >> 1) % 8].append(w)
    assert {r.word: r.n for r in model.counts.collect()} == {int(np.uint64(key[w]).astype(np.int64)): n for w, n in count.items()}
    for doc in (0, 7, 120, 123):
        h = hashing.mix(hashing.words(texts[doc].encode())[0])
        ids = model.vocabulary.ids(h)
        want = float(model.network.log_probability(lm.windows(ids, 2), ids).sum())
        for w, i in zip(texts[doc].split(), ids.tolist()):
            if i <= 8:
                total = sum(count[x] for x in share[i])
                want += np.log(count[w] - 1 + p.smooth) - np.log(total - 1 + p.smooth * len(share[i]))
        assert got[doc].log_likelihood == pytest.approx(want, rel=1e-4)
    for i, some in share.items():  # a distribution over the words of an id, and one more word
        n = np.array([*(count[w] for w in some), 0])
        assert np.exp(lm.own_log_probability(n, np.full(len(n), i), model.shared, p.smooth, False)).sum() == pytest.approx(1)
    other = {r.doc_id: r for r in lm.score_documents(spark.createDataFrame([(1, "never seen words"), (2, texts[0])], "doc_id long, text string"), p, model=model).collect()}
    assert np.isfinite(other[1].log_likelihood) and other[2].log_likelihood > got[0].log_likelihood


# HTML text

NAV = '<nav><ul><li><a href="/a">Menu&nbsp;one</a></li></ul></nav>'


def page(body, more=""):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{NAV}<!-- no --><div class=\"ad\">Buy</div>{body}{more}<footer>&copy; x</footer></body></html>"


def test_html_pages():
    one = lambda h: html_text.main_text(html_text.parse(h)[0], frozenset())
    assert one(page("<article><h1>A &amp; B</h1><p>one<br>two <b>bo</b>ld<p>x &#x41;\n\t y</article>")) == "A & B one two bold x A y"
    assert one(page('<article><p>in<aside>side</aside><form>f</form><section id="comments"><p>c</section>out</article>')) == "in out"
    assert one(page("<article><p>cut off")) == "cut off © x" or one(page("<article><p>cut off")).startswith("cut off")
    assert one("<article><p>cut <b>off</art") == "cut off" or one("<article><p>cut <b>off</art").startswith("cut off")
    assert one(page('<div role="main"><p>m</div>')) == "m"
    assert one("") == "" and one("plain text") == "plain text" and one("<article></article>") == ""
    assert one('<article><div class="notice-box">n</div><div class="loaded">kept</div><p title="a>b">q</p><textarea>z</textarea></article>') == "kept q"
    assert one('<article><p hidden>a</p><p style="display: none">b</p><p aria-hidden="true">c</p><p class="hidden-gem" data-x="hidden">d</p></article>') == "d"
    assert one('<article><p>It<!-- a --> is <em>so</em>, a&lt;b &copy;</p><ul><li>x<li>y</ul><div class="reader-comments"><p>no</p></div></article><aside>s</aside>') == "It is so, a<b © x y"


def test_templates(spark):
    rows = [(i, f"http://H.example.com/{i}", page(f"<div><p>story {i} {i}</div>", "<p>Follow our letter now</p>")) for i in range(6)]
    rows += [(50, "http://few.example.com/", page("<div><p>alone</div>", "<p>Follow our letter now</p>")), (51, None, None), (52, "x", ""), (0, "http://h.example.com/0", rows[0][2])]
    rows += [(60 + i, f"http://same.example.com/{i}", page("<article><p>the same article</article>")) for i in range(5)]
    rows += [(80 + i, f"http://copies.example.com/{i}", page("<div><p>copied story</div>")) for i in range(5)]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, template string")
    got = Counter((r.page_id, r.text, r.n_chars) for r in html_text.extract_text(pages).collect())
    want = Counter([(i, f"story {i} {i}", len(f"story {i} {i}")) for i in [*range(6), 0]] + [(50, "alone Follow our letter now", 27), (51, "", 0), (52, "", 0)] + [(60 + i, "the same article", 16) for i in range(5)] + [(80 + i, "copied story", 12) for i in range(5)])
    assert got == want
    assert html_text.extract_text(pages.limit(0)).count() == 0
    tokens = {r.host: r.template for r in html_text.deduce_templates(pages).collect()}
    assert set(tokens) == {"h.example.com", "same.example.com", "copies.example.com"}


def test_templates_decide_inside_articles(spark):
    notice = "<div class=\"box\"><p>Read the terms of this host</div>"
    rows = [(i, f"http://h.example.com/{i}", page(f"<article><p>story {i}{notice}<p>end of {i}</article>")) for i in range(6)]
    copy = "".join(f"<p>part {k} of a story that was copied to most of the pages of a host</p>" for k in range(5))
    rows += [(20 + i, f"http://c.example.com/{i}", page(f"<article>{copy}{'<p>more</p>' if i else ''}{notice}</article>")) for i in range(5)]
    rows += [(30 + i, f"http://c.example.com/o{i}", page(f"<article>{''.join(f'<p>other {i} {k}</p>' for k in range(20))}{notice}</article>")) for i in range(2)]
    rows += [(40, "http://d.example.com/", '<div><p>body text</div><div class="comments"><article><p>reader</article></div>')]
    got = {r.page_id: r.text for r in html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    story = " ".join(f"part {k} of a story that was copied to most of the pages of a host" for k in range(5))
    want = {i: f"story {i} end of {i}" for i in range(6)} | {20 + i: f"{story} more" if i else story for i in range(5)}
    want |= {30 + i: " ".join(f"other {i} {k}" for k in range(20)) for i in range(2)} | {40: "body text"}
    assert got == want


def test_equivalence_classes(spark):
    """Classes from XORed vectors equal classes from whole vectors."""
    pages = [page("".join(f"<p>{k}</p>" for k in range(n)) + "<ul>" + "<li>i</li>" * (n % 3) + "</ul>") for n in (1, 2, 3, 4, 5)]
    df = spark.createDataFrame([("http://h/", p) for p in pages], "host string, html string")
    got = df.mapInArrow(html_text._count, "host string, token long, pages long, vector long, place long").groupBy("token").agg({"pages": "sum", "vector": "bit_xor"}).collect()
    vectors = defaultdict(lambda: [0] * len(pages))
    for k, p in enumerate(pages):
        for t in html_text.parse(p)[1]:
            vectors[int(np.uint64(t).astype(np.int64))][k] += 1
    classes, brute = defaultdict(set), defaultdict(set)
    for r in got:
        if r.token:
            classes[r[1], r[2]].add(r.token)
    for t, v in vectors.items():
        brute[tuple(v)].add(t)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, brute.values()))


def test_markup_and_names():
    text = lambda body: html_text.main_text(html_text.parse(page(body))[0], frozenset())
    assert text('<article><p class="x>Hello</p><p class="y">there</p></article>') == "Hello there"
    assert text("<article><p title=it's>It</p><p>doesn't</p></article>") == "It doesn't"
    assert html_text.main_text(html_text.parse('<article><p>one</p><a href="x" ')[0], frozenset()) == "one"
    assert html_text.main_text(html_text.parse("<article><p>one</p></arti")[0], frozenset()) == "one"
    assert text("<article><p data-x='a > b' title=\"c > d\">kept</p><p>1 < 2</p></article>") == "kept 1 < 2"
    assert text('<main><div class="related-work">Body</div><p class="share-price">1</p><table class="widget-specs"><tr><td>2</td></tr></table></main>') == "Body 1 2"
    for name in ("comments-section", "siteFooter", "cookie_banner", "ad", "ad-slot-3", "nav-bar", "newsletter signup"):
        assert text(f'<article><p>kept</p><div class="{name}">gone</div></article>') == "kept"
    long = "<article>" + "<p>word</p>" * 50_000 + "</article>"
    assert text(long) == " ".join(["word"] * 50_000)
    assert html_text.parse("<" * 3000 + "a" * 3000 + '"' * 3001)[0] is not None


def brute_template(pages, share):
    """Tokens of nesting classes by whole vectors, classes from the most frequent and largest down."""
    count = [Counter(html_text.parse(p)[1]) for p in pages]
    place = [{} for _ in pages]
    for k, p in enumerate(pages):
        for i, t in enumerate(html_text.parse(p)[1]):
            place[k].setdefault(t, i)
    classes = defaultdict(list)
    for t in set().union(*count):
        vector = tuple(c[t] for c in count)
        if sum(map(bool, vector)) >= share * len(pages):
            classes[vector].append((t, np.mean([q[t] for q in place if t in q])))
    spans, template = [], set()
    for vector, members in sorted(classes.items(), key=lambda c: (-sum(map(bool, c[0])), -len(c[1]))):
        a, b = min(x for _, x in members), max(x for _, x in members)
        if all(b < x or y < a or (x <= a and b <= y) or (a <= x and y <= b) for x, y in spans):
            spans.append((a, b))
            template |= {t for t, _ in members}
    return template


@pytest.mark.parametrize("tag", ["article", "div"])
def test_slots_against_a_brute_force_template(spark, tag):
    """Pages of small hosts, with and without article elements; without the template their texts would differ."""
    rows, k = [], 0
    for host in range(6):
        notice = f"<p>{prose(9)}</p>"
        for _ in range(5 + host):
            parts = [f"<p>{prose(int(rng.integers(5, 30)))}</p>" for _ in range(int(rng.integers(1, 5)))]
            parts.insert(int(rng.integers(len(parts) + 1)), notice)
            rows.append((k, f"http://h{host}.org/{k}", page(f"<{tag}>" + "".join(parts) + f"</{tag}>"), notice[3:-4]))
            k += 1
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, notice string")
    got = {r.page_id: r.text for r in html_text.extract_text(pages).collect()}
    changed = 0
    for host in {r[1].split("/")[2] for r in rows}:
        mine = [r for r in rows if r[1].split("/")[2] == host]
        template = brute_template([r[2] for r in mine], 0.5)
        for i, _, html, notice in mine:
            blocks = html_text.parse(html)[0]
            assert got[i] == html_text.main_text(blocks, template) and notice not in got[i]
            changed += got[i] != html_text.main_text(blocks, frozenset())
    assert changed == len(rows)


def test_valid_classes_nest():
    place, pages = np.array([0.0, 9, 2, 4, 3, 6, 5, 12]), np.array([9, 9, 8, 8, 7, 7, 6, 6])
    keep = html_text.valid_classes(pages.copy(), pages, place)
    assert keep.tolist() == [True, True, True, True, False, False, False, False]


# records


def test_records(spark):
    texts = ["hello world", "", None, "a b  c", "same", "same", "é " * 500, "<|endoftext|>"]
    rows = [(i if i != 3 else None, t, 1) for i, t in enumerate(texts)] + [(4, "same", 2), (7, "other", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start long")
    params = records.RecordParams(tokenizer_file("byte_bpe_50k.json"))
    manifest = records.write_records(docs, scratch_path(spark, "test-records"), params)
    back = records.read_records(manifest).orderBy("start").collect()
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(params.tokenizer)
    want = Counter((r[0], tuple([*tok.encode(r[1] or "", add_special_tokens=False).ids, 2])) for r in rows)
    assert Counter((r.doc_id, tuple(unpack_ids(r.ids).tolist())) for r in back) == want
    ids = [-1 if r.doc_id is None else r.doc_id for r in back]
    assert ids == sorted(ids)
    at = 0
    for r in back:
        assert r.start == at
        at += len(unpack_ids(r.ids))
    total = 0
    for m in manifest.collect():
        f = records.RecordFile(m.path)
        assert len(f) == m.records
        total += sum(len(f[k][1]) for k in reversed(range(len(f))))
    assert total == at
    report = records.record_report(docs, params).collect()
    assert Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in report) == Counter((r.doc_id, r.start, len(unpack_ids(r.ids)), zlib.crc32(unpack_ids(r.ids).tobytes())) for r in back)
    assert records.record_report(docs.limit(0), params).count() == 0


def test_damaged_records_are_told():
    data = records.frame(b"payload") + records.frame(b"")
    first, at = records.unframe(data)
    assert first == b"payload" and records.unframe(data, at) == (b"", len(data))
    for k in range(len(data)):
        bad = bytes([*data[:k], data[k] ^ 1, *data[k + 1 :]])
        with pytest.raises(ValueError):
            records.unframe(bad, records.unframe(bad)[1])
    with pytest.raises(ValueError):
        records.unframe(data[:-1], at)


def test_damaged_files_are_told(spark, tmp_path):
    data = records.frame(bytes([1]) + bytes(8) + b"\2\1\0") + records.frame(bytes(9) + b"\2\7\0")
    bad = {k: bytes([*data[:k], data[k] ^ 0x40, *data[k + 1 :]]) for k in (0, 5, 7, 9, 14, 26, len(data) - 1)}
    for name, content in {**bad, "head": data[: len(data) - 20], "body": data[:-6]}.items():
        path = tmp_path / f"{name}.rec"
        path.write_bytes(content)
        manifest = spark.createDataFrame([(0, str(path), 2, 2)], records.MANIFEST)
        with pytest.raises(Exception, match="ValueError: a record"):
            records.read_records(manifest).collect()
    path.write_bytes(data)
    assert [(r.doc_id, r.start) for r in records.read_records(manifest).collect()] == [(0, 0), (None, 1)]


# sharding


def test_hilbert_curve_steps_to_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2), (3, 1)):
        grid = np.stack([g.ravel() for g in np.meshgrid(*[np.arange(1 << bits)] * dims)], 1)
        place = sharding.hilbert_index(list(grid.T), bits)
        assert sorted(place.tolist()) == list(range(len(grid)))
        path = grid[np.argsort(place)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def shard_rows():
    out = [(i, prose(int(rng.integers(1, 60))), ["en", "de", "fr"][i % 3], f"src{i % 7}", "x") for i in range(500)]
    return [*out, out[0], (None, None, None, None, "x"), (501, "", "en", None, "x")]


def test_sharding(spark, tmp_path):
    rows = shard_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, place string")
    got = sharding.shard_report(docs).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    shards = defaultdict(list)
    for r in got:
        shards[r.shard].append((r.slot, r.place))
        assert r.law == "rows" and r.grown_shard is None
    assert set(shards) == set(range(16)) and max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    last = -1
    for k in range(16):
        slots = sorted(shards[k])
        assert [s for s, _ in slots] == list(range(len(slots))) and [p for _, p in slots] == sorted(p for _, p in slots) and slots[0][1] >= last
        last = slots[-1][1]
    sharding.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.columns == [*docs.columns, "shard"]
    n = [r.n for r in back.groupBy("shard").count().withColumnRenamed("count", "n").collect()]
    assert back.count() == len(rows) and len(n) == 16 and max(n) - min(n) <= 1
    seen = back.where("doc_id is not null").groupBy("shard").agg({"source": "approx_count_distinct", "lang": "approx_count_distinct"}).collect()
    assert sum(r[1] * r[2] for r in seen) / len(seen) < 0.5 * 3 * 8  # a shard spans a small part of the grid
    of = lambda df: Counter((r.doc_id, r.shard) for r in df.collect())
    assert of(back) == of(sharding.shard_report(docs))
    sharding.write_shards(docs.withColumnRenamed("place", "shard"), str(tmp_path / "clash"))
    assert spark.read.parquet(str(tmp_path / "clash")).columns == ["doc_id", "text", "lang", "source", "shard"]
    sharding.write_shards(docs.limit(0), str(tmp_path / "none"))
    assert sharding.shard_report(docs.limit(0)).count() == 0
    assert [r.shard for r in sharding.shard_report(docs.limit(3)).orderBy("shard").collect()] == [0, 5, 10]


def test_shards_tell_long_names_apart(spark):
    docs = spark.createDataFrame([(i, "same text", "en", f"https://www.example.org/crawl/{i % 16:02d}", "x") for i in range(320)], "doc_id long, text string, lang string, source string, place string")
    got = sharding.hilbert_shards(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("shard").agg({"source": "approx_count_distinct"}).collect()
    assert [r[1] for r in got] == [1] * 16


def test_repeated_rows_at_a_cut(spark, tmp_path):
    docs = spark.createDataFrame([(7, "same", "en", "s")] * 100, "doc_id long, text string, lang string, source string")
    sharding.write_shards(docs, str(tmp_path / "out"))
    n = [r[1] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().collect()]
    assert sum(n) == 100 and len(n) == 16 and max(n) - min(n) <= 1


def test_substring_of_empty_and_short_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert substring.repeated_spans(docs).count() == 0 and substring.repeated_spans(docs.limit(0)).count() == 0
    assert sorted(r.doc_id for r in substring.remove_spans(docs).collect()) == [1, 2]


def test_rows_that_share_an_id_are_one_document(spark):
    text = prose(60)
    docs = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    assert substring.repeated_spans(docs).count() == 0


def test_rows_that_share_an_id_are_cut_on_their_own(spark):
    a, b = prose(60), prose(60)
    docs = spark.createDataFrame([(1, a, "x", 1), (2, a, "y", 2), (2, b, "z", 3), (2, None, "n", 4), (None, a, "u", 5)], "doc_id long, text string, _of string, _spans int")
    got = {r._spans: (r.doc_id, r.text, r._of) for r in substring.remove_spans(docs).collect()}
    assert got == {1: (1, a, "x"), 2: (2, "", "y"), 3: (2, b, "z"), 4: (2, None, "n"), 5: (None, a, "u")}


def test_the_article_is_what_holds_the_text(spark):
    of = lambda page: html_text.main_text(html_text.parse(page)[0], frozenset())
    body = prose(40)
    assert body in of(f"<body><article class='teaser'>Teaser</article><div><p>{body}</p></div></body>")
    assert of(f"<body><div>Aside of some words</div><article><p>{body}</p></article></body>") == body
    assert of("<p>Intro text.</p><p><a href='/x'>all of it a link</a></p><p>End.</p>") == "Intro text. all of it a link End."
    assert of("<ul><li><a href='/a'>One</a><li><a href='/b'>Two</a></ul><p>Text.</p><ul><li><a href='/c'>A reference</a></ul>") == "Text. A reference"
    assert of("") == "" and of("<ul><li><a href='/a'>One</a><li><a href='/b'>Two</a></ul>") == ""


def test_templates_alone_part_text_from_the_rest(spark):
    """Pages of nothing but div and p, with a teaser, a line of links and a notice that repeat."""
    texts = [prose(30) for _ in range(6)]
    page = lambda t: f"<div><article>Read on</article></div><div><p>Home of words</p></div><div><p>{t}</p><p><a href='/l'>{t[:20]}</a></p></div><div><p>We said it before</p></div>"
    pages = spark.createDataFrame([(k, f"http://h.example/{k}", page(t)) for k, t in enumerate(texts)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_text.extract_text(pages).collect()} == {k: f"{t} {t[:20].strip()}" for k, t in enumerate(texts)}


def test_scores_do_not_depend_on_partitions(spark):
    docs = spark.createDataFrame([(i % 150, prose(int(rng.integers(1, 60)))) for i in range(200)] + [(7, None), (None, prose(5))], "doc_id long, text string")
    p = lm.LmParams(classes=6, hashed=8, step=64, block=16, shard=700)
    one, many = ({(r.doc_id, r.n_tokens): r.log_likelihood for r in lm.score_documents(df, p).collect()} for df in (docs.coalesce(1), docs.repartition(9)))
    assert set(one) == set(many) and all(one[k] == pytest.approx(many[k], rel=1e-5) for k in one)
    rows = lm._rows(docs, p, "text", "doc_id")
    dealt = lm.sharded(rows, lm.fit(docs, p).vocabulary, 5000, p)
    assert dealt.select("shard").distinct().count() == 8 == dealt.rdd.getNumPartitions()  # as many as the corpus asks for
