"""The pipeline's stages, one after another, against brute force on a small corpus."""

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from loomcrawl.llm.packing import unpack_ids
from loomcrawl.llm.quality import base_counts

rng = np.random.default_rng(8)
WORDS = [f"w{i}" for i in range(900)]


def prose(n):
    return " ".join(rng.choice(WORDS, n))


def edited(text, *places):
    w = text.split()
    for k in places:
        w[k] = f"edit{k}"
    return " ".join(w)


def shingles(text):
    w = text.lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    rows = [(i, prose(int(rng.integers(60, 150))), "en", f"s{i % 3}", 1) for i in range(150)]
    rows += [(200 + i, rows[i][1].upper() if i % 2 else rows[i][1], "en", "s0", 1) for i in range(20)]  # exact copies
    rows += [(500 + i, edited(rows[30 + i][1], 20), "en", "s1", 1) for i in range(25)]  # near copies, above 0.8
    rows += [(540 + i, edited(rows[60 + i][1], 5, 15, 25, 35, 45, 55), "en", "s1", 1) for i in range(10)]  # and below
    rows += [(560 + i, edited(rows[170 + i][1], 40), "en", "s1", 1) for i in range(3)]  # a chain of them
    rows += [(300 + i, " ".join(x + "!!" for x in prose(80).upper().split()), "en", "s1", 1) for i in range(60)]  # junk
    rows += [(400, None, None, None, None), (401, "short", "en", "s2", 1), (402, prose(9000), "en", None, 1), rows[0]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(folder / "documents.parquet"))
    labels = [(i, 1, 0) for i in range(0, 150, 2)] + [(300 + i, 0, 0) for i in range(0, 60, 2)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    return str(folder), {r[0]: r for r in rows}


def test_stages(spark, corpus, tmp_path):
    folder, rows = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    outs, columns = [], docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert docs.columns == columns
        outs.append(docs)
    quality, exact, near, mixed, packed = outs
    kept = Counter(r.doc_id for r in quality.collect())
    want = Counter(i for i, r in rows.items() if r[1] and not 300 <= i < 400 and base_counts(r[1].encode())[0] >= 50) + Counter([0])
    assert kept == want
    texts = {}
    for i in kept:
        t = rows[i][1].lower()
        texts[t] = max(texts.get(t, -1), i)
    assert sorted(r.doc_id for r in exact.collect()) == sorted(texts.values())
    sets = {i: shingles(rows[i][1]) for i in texts.values()}
    label = {i: i for i in sets}
    alike = [(i, j) for i in sets for j in sets if i < j and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])]
    for _ in range(len(alike)):
        for i, j in alike:
            label[i] = label[j] = min(label[i], label[j])
    stay = set(label.values())
    assert len(alike) >= 25 and not any(540 + i not in stay for i in range(10))
    assert sorted(r.doc_id for r in near.collect()) == sorted(stay)
    size = Counter()
    for r in near.collect():
        size[r.source] += len(r.text.split())
    copies = Counter(r.doc_id for r in mixed.collect())
    assert set(copies) <= {r.doc_id for r in near.collect()} and max(copies.values()) <= 3
    tokens = Counter()
    for r in packed.collect():
        tokens[r.doc_id] += len(unpack_ids(r.ids))
        assert r.offset + r.length <= 2048
    assert set(tokens) == set(copies) and all(tokens[i] % copies[i] == 0 for i in tokens)


def test_run_equals_its_stages(spark, corpus):
    folder, _ = corpus
    got = corpus_pipeline.run(spark, folder)
    assert got.count() > 0 and "sequence_id" in got.columns
