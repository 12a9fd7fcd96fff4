"""Prefix and suffix joins, dealt baskets, sliced windows, posting blocks, user aggregates, chunks, files that fail."""

import gzip
import io
import json
import os
import re
import sys
from collections import Counter
from hashlib import md5

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from loomcrawl.functions.text import human_bytes
from loomcrawl.operators import cooc, entities, postings, prefixes, profile, quads, relations, user_aggregates
from loomcrawl.operators.quads import EXTRACTORS
from loomcrawl.operators.relations import row_terms, text_index
from loomcrawl.plans import exchange
from loomcrawl.sources import archives, chunks, text
from loomcrawl.streaming import entities as stream_entities
from loomcrawl.streaming import files
from loomcrawl.streaming.files import process_new_files


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("extended"))


# prefixes


def test_longest_namespace_wins(spark):
    table = spark.createDataFrame([("a", "http://x/"), ("b", "http://x/y/"), ("z", "http://x/y/"), ("e", ""), (None, "http://x/y/z"), ("n", None), ("é", "urn:é:")], "prefix string, namespace string")
    iris = [("http://x/y/z", "b:z"), ("http://x/y/", "b:"), ("http://x/y", "a:y"), ("http://x", "http://x"), ("urn:é:ß", "é:ß"), ("", ""), (None, None), ("http://x/y/z", "b:z")]
    rows = spark.createDataFrame([(i, k, "kept") for i, (k, _) in enumerate(iris)], "prefix int, iri string, _row string")
    got = prefixes.abbreviate(rows, "iri", table)
    assert got.columns == ["prefix", "iri", "_row", "short"]
    assert [r.short for r in got.orderBy("prefix").collect()] == [s for _, s in iris]
    assert prefixes.abbreviate(rows, "iri", table.limit(0)).where("short <=> iri").count() == len(iris)


def test_a_table_of_thousands_is_joined(spark):
    rows = spark.range(10).select(F.lit("http://data.example.org/v3/x").alias("iri"))
    shown = plan(prefixes.abbreviate(rows, "iri", prefixes._namespaces(spark)))
    assert shown.count("CASE WHEN") < 20 and "Join" in shown


def test_public_suffix_rules(spark):
    rules = spark.createDataFrame([("com",), ("*.ck",), ("!www.ck",), ("",), ("// a comment",), (None,), ("a.b.c.com",), ("XN--P1AI",)], "rule string")
    want = {
        "http://www.example.com/x": "example.com", "http://a.b.c.com": None, "http://d.a.b.c.com": "d.a.b.c.com", "http://b.c.com": "c.com", "http://com": None,
        "http://x.foo.ck": "x.foo.ck", "http://foo.ck": None, "http://ck": None, "http://www.ck": "www.ck", "http://a.www.ck": "www.ck", "http://p.xn--p1ai": "p.xn--p1ai",
        "http://one.two.three": "two.three", "http://1.2.3.4/": None, "mailto:a@b.com": None, "http://example.com./": "example.com", "http://a..com": None, None: None,
    }
    got = prefixes.registered_domains(spark.createDataFrame([(u, 1) for u in want], "url string, take int"), "url", rules)
    assert {r.url: r.registered_domain for r in got.collect()} == want


# baskets


def brute_pairs(rows):
    by = {}
    for b, k in rows:
        if k is not None:
            by.setdefault(b, set()).add(k)
    return Counter((x, y) for ks in by.values() for x in ks for y in ks if x < y)


@pytest.mark.parametrize("group", [1, 3, 512])
def test_pairs_of_dealt_baskets(spark, group):
    rows = [(b, k) for b in range(6) for k in range(b * 3, b * 3 + 1 + b * 4) for _ in range(2)] + [(None, 1), (None, 2), (None, None), (9, 5)] + [(7, 4)] * 50
    df = spark.createDataFrame([(b, k, "d" if (k or 0) % 2 else "e") for b, k in rows], "key int, own int, other string").repartition(3)
    got = {(r.a, r.b): r.support for r in cooc.pair_supports(df, "key", "own", group).collect()}
    assert got == brute_pairs(rows)
    by = {(r.a, r.b): (r.support, [(t.place, t.other, t.n) for t in r.top]) for r in cooc.pair_supports_with_domains(df, "key", "own", "other", 1, group).collect()}
    want = brute_pairs([((b, "d" if (k or 0) % 2 else "e"), k) for b, k in rows])
    assert {p: s for p, (s, _) in by.items()} == want


def test_pairs_of_hot_baskets_are_counted_where_they_are_made(spark, monkeypatch):
    monkeypatch.setattr(cooc, "PAIRS", 500)
    rows = [(b, (k * 7 + b) % 150) for b in range(3) for k in range(130 + b)] + [(b, k) for b in range(3, 40) for k in range(b, 3 * b + 1)] + [(None, k) for k in range(140)] + [(4, None)]
    df = spark.createDataFrame([(b, f"k{k:03}" if k is not None else None) for b, k in rows], "b int, k string")
    found = cooc.pair_supports(df, "b", "k", 2)
    assert {(r.a, r.b): r.support for r in found.collect()} == brute_pairs([(b, f"k{k:03}") for b, k in rows if k is not None])
    # nothing is dealt by the pair after the cells
    shown = plan(found).split("Physical Plan")[1]
    assert "REPARTITION_BY_NUM" in shown and "hashpartitioning(a#" not in shown.split("REPARTITION_BY_NUM")[0]


def test_no_pair_moves_as_a_row_where_baskets_are_hot(spark, monkeypatch):
    for name, value in (("PAIRS", 500), ("SIDE", 16), ("CHUNK", 300), ("ROWS", 100)):
        monkeypatch.setattr(cooc, name, value)
    hot = [(b, 3 * k) for b in (-1, -2) for k in range(b + 140)] + [(-3, 200 + 2 * k) for k in range(135)]
    usual = [(b, (b * b + k * 37) % 600) for b in range(60) for k in range(b)] + [(b, 3) for b in range(100, 140)] + [(b, 9) for b in range(100, 140)] + [(None, 3), (None, 6), (None, None)]
    # keys that hot baskets have, and others beside them
    for rows in (hot + usual, [(b, k) for b, k in hot + usual if k in {k for _, k in hot}]):
        found = cooc.pair_supports(spark.createDataFrame(rows, "b int, k long").repartition(3), "b", "k", 2)
        got = found.collect()
        assert len(got) == len({(r.a, r.b) for r in got}) and {(r.a, r.b): r.support for r in got} == brute_pairs(rows)
    assert "hashpartitioning(a#" not in plan(found)


def test_packed_pairs_come_back():
    rng = np.random.default_rng(5)
    n, side = 3, 512
    spread, near = rng.integers(0, side * side, 3), rng.integers(0, 9000, 9000)
    codes = [np.concatenate([1 * side * side + spread, 2 * side * side + near, 2 * side * side + spread, np.full(700, 5 * side * side + side * side - 1), [5 * side * side]])]
    want = Counter(codes[0].tolist())
    packed = cooc._packed(codes, side * side)
    assert max(map(len, packed.column(1).to_pylist())) <= 2 * (cooc.PIECE + side * side // 65535) and packed.num_rows == 5
    rows = [(c, -1, 2, None, None, at, m) for c, at, m in zip(*(x.to_pylist() for x in packed.columns))]
    # keys of a cell are places here
    rows += [(c, -1, k, list(range(side)), None, None, None) for c in (1, 2, 5) for k in (0, 1)]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int16()), pa.binary(), pa.binary()]
    for c in (1, 2, 5):
        some = sorted((r for r in rows if r[0] == c), key=lambda r: r[2])
        batch = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*some), types)], names=list("abcdefg"))
        got = {c * side * side + x * side + y: m for b in cooc._counter(n, side)(iter([batch])) for x, y, m in zip(*(x.to_pylist() for x in b.columns))}
        assert got == {k: m for k, m in want.items() if k // (side * side) == c}


def test_no_row_has_more_than_two_groups(spark):
    n, group = 20_000, 256
    items = spark.range(n).select(F.lit("hot").alias("b"), "id").unionByName(spark.range(100).select((F.col("id") % 10).cast("string").alias("b"), "id"))
    cells = cooc.basket_cells(items, ["b"], "id", group)
    r = cells.select("basket.b", F.size("own").alias("x"), F.when(F.col("other").isNotNull(), F.size("other")).alias("y")).where("b = 'hot'")
    most, pairs, rows = r.selectExpr("max(greatest(x, coalesce(y, 0)))", "sum(coalesce(cast(x as long) * y, cast(x as long) * (x - 1) div 2))", "count(*)").first()
    groups = -(-n // group)
    assert most < 1.5 * group and pairs == n * (n - 1) // 2 and rows == groups * (groups + 1) // 2


# windows


def brute_rates(rows, seconds):
    out = {}
    for i, t, v in rows:
        if t is None:
            out[i] = (None, None, None)
            continue
        t0, oldest = min((u, w) for _, u, w in rows if u is not None and t - seconds <= u <= t)
        rate = (oldest - v) / (t - t0) if t > t0 else None
        out[i] = (oldest, rate, v * (t - t0) / (oldest - v) if rate and rate > 0 else None)
    return out


@pytest.mark.parametrize("slices", [1, 2, 8, 1000])
def test_a_series_in_slices(spark, slices):
    rows = [(i, t, 1000 - 3 * i + i % 7) for i, t in enumerate([0, 0, 1, 119, 120, 121, 240, 241, 360, 960, 961, 1079, 1080, 5000, 5000, 5119, 7680, 7799, 7800, None, None, -1, -120, -121])]
    df = spark.createDataFrame(rows, "row long, t long, own long").withColumn("ts", F.timestamp_seconds("t"))
    got = profile.rate_window(df, "ts", "own", slices=slices)
    assert got.columns == ["row", "t", "own", "ts", "oldest", "span", "rate", "seconds_left"]
    want = brute_rates(rows, 120)
    near = lambda x, y: x == y or (x is not None and y is not None and abs(x - y) < 1e-9)
    found = got.collect()
    assert len(found) == len(rows) and all(near(a, b) for r in found for a, b in zip((r.oldest, r.rate, r.seconds_left), want[r.row]))


def test_no_window_is_longer_than_a_slice_and_its_halo(spark):
    df = spark.range(50_000).select("id", F.timestamp_seconds("id").alias("ts"), F.lit(1).alias("v"))
    shown = plan(profile.rate_window(df, "ts", "v"))
    assert "slice" in shown and "SinglePartition" not in shown.split("Physical Plan")[1]


def test_windows_only_grow(spark):
    df = spark.range(50).select("id", F.timestamp_seconds("id").alias("ts"), F.lit(1).alias("v"))
    shown = plan(profile.rate_window(df, "ts", "v")).split("Physical Plan")[1]
    assert "RowFrame, unboundedpreceding$(), currentrow$()" in shown and "RangeFrame" not in shown


# archives


def test_records_of_one_uri_lie_in_the_order_of_their_ids(spark, tmp_path):
    pages = [(9, "http://a.org/1", "x" * 9), (2, "http://a.org/1", "x"), (5, "http://a.org/1", None), (1, "http://a.org/2", "y" * 5), (7, "http://a.org/1", "x" * 4)]
    pages += [(k + p, u.replace("a.org", f"a{k}.org"), h) for k in range(10, 200, 10) for p, u, h in pages]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = {(r.uri, r.html_md5): r.offset for r in exchange.warc_by_index(spark, str(tmp_path)).collect()}
    places = {u: [got[u, md5((h or "").encode()).hexdigest()] for _, x, h in sorted(pages) if x == u] for u in {u for u, _ in got}}
    assert any(len(v) == 4 for v in places.values()) and all(v == sorted(v) for v in places.values())


def test_records_without_a_uri_move_no_others(spark, tmp_path):
    pages = [(k, f"http://a{k}.org/" if k % 3 else None, "x" * k if k % 4 else None) for k in range(60)]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    want = con.sql(f"select uri, bytes, html_md5, \"offset\" from ({exchange.ORACLE_SQL['warc_by_index']})").fetchall()
    got = exchange.warc_by_index(spark, str(tmp_path)).select("uri", "bytes", "html_md5", "offset").collect()
    assert len(want) > 5 and sorted(map(tuple, got)) == sorted(want)


# postings


def test_postings_round_trip_and_lookup(spark, tmp_path):
    rows = [(-5, "a b"), (0, "a"), (63, "a b b"), (64, "b"), (200, "a b c"), (10**12, "a b c"), (7, None), (8, "")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, t string, range int")
    index = docs.where("t is not null").select("doc_id", F.explode(F.split("t", " ")).alias("term")).where("term <> ''").groupBy(F.lit("f").alias("field"), "term", "doc_id").agg(F.count("*").alias("tf"))
    blocks = postings.posting_blocks(index, range_bits=6)
    assert {(r.term, r.first, r.last, r.df) for r in blocks.collect()} >= {("a", -5, -5, 1), ("a", 0, 63, 2), ("a", 10**12, 10**12, 1), ("b", 64, 64, 1)}
    assert sorted(map(tuple, postings.postings(blocks, 6).collect())) == sorted(map(tuple, index.collect()))
    postings.write_postings(index, str(tmp_path / "p"), range_bits=6)
    read = postings.read_postings(spark, str(tmp_path / "p"))
    found = lambda *t: {r.doc_id: r.tf for r in postings.lookup(read, "f", list(t), 6).collect()}
    assert found("a", "b") == {-5: 2, 63: 3, 200: 2, 10**12: 2} and found("a", "b", "c", "a") == {200: 3, 10**12: 3} and found("c") == {200: 1, 10**12: 1}
    assert found("a", "none") == {} and found() == {} and {r.doc_id for r in postings.lookup(read, "g", ["a"], 6).collect()} == set()
    assert postings.posting_blocks(index.limit(0), range_bits=6).count() == 0


def test_a_hot_term_has_many_blocks(spark):
    index = text_index(spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("hot").alias("t")), "doc_id", {"t": F.col("t")})
    blocks = postings.posting_blocks(index, range_bits=8).selectExpr("count(*)", "max(df)", "sum(df)").first()
    assert tuple(blocks) == (20, 256, 5000)


def test_terms_are_counted_inside_rows_and_added_up_in_blocks(spark):
    rows = [(7, "b a b", "x"), (7, "b c", None), (None, "lost", "x"), (70, None, "x"), (8, "", "Été's été")]
    df = spark.createDataFrame(rows, "doc_id int, t string, u string").repartition(3)
    fields = {"t": F.col("t"), "u": F.col("u")}
    counted = row_terms(df, "doc_id", fields)
    assert "Exchange" not in counted._jdf.queryExecution().optimizedPlan().toString() and counted.where("doc_id = 7 and term = 'b'").count() == 2
    whole = text_index(df, "doc_id", fields)
    assert counted.schema["doc_id"] == whole.schema["doc_id"]
    of = lambda index: sorted((r.field, r.term, r.range, r.first, r.last, r.df, r.gaps, r.tfs) for r in postings.posting_blocks(index, range_bits=6).collect())
    assert of(counted) == of(whole) and ("t", "b", 0, 7, 7, 1, [7], [3]) in of(counted) and ("u", "ete", 0, 8, 8, 1, [8], [2]) in of(counted)


def test_blocks_go_on_over_batches(spark):
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(batch)
    index = spark.range(1000).selectExpr("'f' as field", "'t' || (id % 3) as term", "id as doc_id", "1L as tf")
    try:
        spark.conf.set(batch, "7")
        got = postings.posting_blocks(index, range_bits=8).selectExpr("count(*)", "max(df)", "sum(df)", "sum(aggregate(tfs, 0, (a, x) -> a + x))").first()
    finally:
        spark.conf.set(batch, was)
    assert tuple(got) == (12, 86, 1000, 1000)


# entities


def _random_quads(seed):
    """Statements of a few documents: nested, shared, typed, unheld and circular blank nodes, and types that are blank nodes."""
    rng, rows = np.random.default_rng(seed), []
    for pos in range(400):
        g = int(rng.integers(6))
        s = f"http://s/{rng.integers(4)}" if rng.random() < 0.4 else f"_:b{rng.integers(6)}"
        p = quads.RDF_TYPE if rng.random() < 0.15 else f"http://p/{rng.integers(5)}"
        o, kind = (f"_:b{rng.integers(6)}", "bnode") if rng.random() < 0.3 else (f"v{rng.integers(9)}", "literal")
        rows.append((f"http://g{g}/", s, p, o, kind, pos))
    return rows


@pytest.mark.parametrize("depth", [0, 1, 3])
def test_entities_by_brute_force(spark, depth):
    rows = _random_quads(depth)
    df = spark.createDataFrame(rows, "graph string, s string, p string, o string, o_kind string, pos long").repartition(3)
    want = {}
    for g in {r[0] for r in rows}:
        for s, props in stream_entities.assemble([(r[1], r[2], r[3], r[4], r[5]) for r in rows if r[0] == g], depth):
            if props:
                want[g, s] = props
    assert {(r.context, r.url): r.props for r in entities.entities(df, depth).collect()} == want and len(want) > 10
    told = {}
    for r in entities.entity_properties(df, depth).collect():
        told.setdefault((r.graph, r.subject), set()).add((r.p, r.o, r.pos))
    assert told.keys() == want.keys() and all({p for p, _, _ in told[k]} == want[k].keys() for k in want)


def test_entities_without_nested_nodes_write_no_tables(spark, monkeypatch):
    written = []
    monkeypatch.setattr(entities, "saved", lambda df, name: written.append(name) or df)
    rows = [("g", "s", quads.RDF_TYPE, "T", "iri", 1), ("g", "s", "p", "_:a", "bnode", 2), ("g", "_:a", "q", "v", "literal", 3)]
    df = spark.createDataFrame(rows, "graph string, s string, p string, o string, o_kind string, pos long")
    (e,) = entities.entities(df).collect()
    assert e.props == {quads.RDF_TYPE: "T", "q": "v"} and written == []


# quads


def test_lines_are_matched_once_and_whole(spark):
    sep = '> "<'
    lines = [
        r'<http://s> <http://p> "a> \"<b> \"<" <http://g> <ex:html-rdfa> .', '_:a> "< <p> _:b <g> .', r'_:a>"< <p> _:b>\"< <g> .', '<> <> <> <> .', '<s> <p> "" <g> .', '<s> <p> ""@en <g> .', r'<s> <p> "x\\"^^<> <g> .',
        sep.join("12345678901"), sep * 12, None, "", "# no", '<s> <p> "$1 \\\\" <g> .', "  _:x <p> <o>   <g> <ex:e>  .  \n", '<s> <p> "two\nlines" <g> .', "<s> <p> _:_ _:g .",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = quads.parse_quads(df)
    want = []
    for m in (re.match(quads.QUAD.replace("\\S", "[^ \\n]"), x) for x in lines if x):
        if m:
            kind = "bnode" if m[5] is not None else "iri" if m[4] is not None else "literal"
            o = m[5] if kind == "bnode" else m[4] if kind == "iri" else re.sub(r"\\(.)", r"\1", m[6])
            want.append((m[1] if m[1] else m[2] or "", "bnode" if m[2] else "iri", m[3], o, kind, m[7] or None, m[8] or None, m[9], m[10] or None))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want)) and len(want) == 9
    # with a filter on a part, too
    assert "regexp_extract" not in plan(quads.demux(got)) and plan(quads.demux(got).select("s")).split("Physical Plan")[1].count("regexp_replace") == 1


def test_lines_of_a_small_file_are_dealt(spark):
    assert "RoundRobinPartitioning" in plan(quads.quad_demux(spark, "/root/testdata/sf0.001"))


# user aggregates


class Longest:
    """The longest string, ties by order; a state of its own kind."""

    columns, result = ("s",), "string"

    def init(self):
        return (0, "")

    def update(self, state, rows):
        return min([state, *((-len(s), s) for s in rows["s"].to_pylist() if s is not None)])

    def merge(self, a, b):
        return min(a, b)

    def finish(self, state):
        return state[1] or None


def test_user_aggregates(spark):
    rows = [(k, s) for i in range(40) for k, s in ((1, "a" * (i % 9)), (2, None), (None, f"n{i}"), (i, "z"))]
    df = spark.createDataFrame([(k, s, 0) for k, s in rows], "k0 int, s string, task int").repartition(7)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    got = {r.k0: r.value for r in user_aggregates.aggregate_by(df, ["k0"], Longest()).collect()}
    want = {}
    for k, s in rows:
        want.setdefault(k, []).append(s)
    assert got == {k: (min((-len(s), s) for s in v if s is not None)[1] if any(s is not None for s in v) else None) for k, v in want.items()}
    assert [tuple(r) for r in user_aggregates.aggregate_by(df, [], user_aggregates.Support("task")).collect()] == [(0,)]
    assert user_aggregates.aggregate_by(df.limit(0), ["k0"], Longest()).count() == 0


def test_states_meet_in_a_tree(spark):
    df = spark.range(64).selectExpr("'hot' as k", "id").repartition(64)
    shown = plan(user_aggregates.aggregate_by(df, ["k"], user_aggregates.Support("id"))).split("Physical Plan")[1]
    assert shown.count("MapInArrow") == 1 + len(user_aggregates.PARTS) + 1
    assert user_aggregates.aggregate_by(df, ["k"], user_aggregates.Support("id"), "n").first().n == 64 * 63 // 2


def test_supports_without_values():
    s, i, d = user_aggregates.Support("x"), user_aggregates.Intersection("x"), user_aggregates.DomainSupport("x", 1)
    none, some = pa.table({"x": pa.array([None], pa.int64())}), pa.table({"x": [3, 5]})
    assert s.update(s.init(), none) == 0 and i.update(i.init(), none) == 0 and i.update(i.init(), some) == 3 and i.merge(None, 4) == 4 and i.finish(i.init()) is None
    assert d.finish(d.update(d.init(), pa.table({"x": ["b", None, "a", "b"]}))) == ["b 2"]


# chunks

LINES = [f'<http://s/{i}> <http://p> "{"x" * (i % 50)}{i * 7919}" <http://g> <ex:{e}> .' for i, e in enumerate(EXTRACTORS[:3] * 2000)]


def test_chunks_by_size(spark, tmp_path):
    path = str(tmp_path / "out")
    odd = ["no statement", "", '<a> <b> <c> <g> <ex:unknown-kind> .', None]
    chunks.write_chunks(spark.createDataFrame([(x,) for x in LINES + odd], "value string").repartition(3), path, 8000, 2000)
    assert sorted(r.value for r in chunks.read_chunks(spark, path).collect()) == sorted(LINES)
    found = list((tmp_path / "out").rglob("*.nq.gz"))
    assert max(f.stat().st_size for f in found) <= 8000 and len(found) > 9 and {f.parent.name for f in found} == set(EXTRACTORS[:3])
    for f in found:
        assert all(f"<ex:{f.parent.name}>" in line for line in gzip.decompress(f.read_bytes()).decode().splitlines())
    assert json.loads((tmp_path / "out/counts.json").read_text()) == {"files": len(found), "lines": len(LINES), "unknown": 1, "unparsable": 3}
    assert chunks.chunk_counts(spark, path).first().unparsable == 3
    chunks.write_chunks(spark.createDataFrame([], "value string"), str(tmp_path / "none"))
    assert chunks.chunk_counts(spark, str(tmp_path / "none")).first().lines == 0


def test_failed_jobs_leave_no_chunks(spark, tmp_path):
    path = str(tmp_path / "bad")

    @F.udf("string")
    def fails(x):
        if "/5999>" in x:
            raise ValueError("a task that fails")
        return x

    with pytest.raises(Exception, match="a task that fails"):
        chunks.write_chunks(spark.createDataFrame([(x,) for x in LINES], "value string").repartition(4).select(fails("value").alias("value")), path, 8000, 1000)
    assert not (tmp_path / "bad").exists() or not list((tmp_path / "bad").rglob("*"))


# files that fail


def test_files_that_keep_failing_are_set_aside(spark, tmp_path):
    for k in range(7):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / f"in/{k}").write_text("boom\n" if k == 3 else "once\n" if k == 5 else f"{k}\n")
    log = str(tmp_path / "log")
    os.mkdir(log)

    def work(lines):
        def run(batches):
            for b in batches:
                for v in b.column(0).to_pylist():
                    if v == "boom" or v == "once":
                        open(f"{log}/{v}-{len(os.listdir(log))}", "w").close()
                        if v == "boom" or sum(x.startswith("once") for x in os.listdir(log)) < 4:
                            raise ValueError(f"cannot read {v}")
                yield b

        return lines.mapInArrow(run, "value string")

    go = lambda: process_new_files(spark, str(tmp_path / "in"), work, str(tmp_path / "out"), str(tmp_path / "cp"), dead_letters=str(tmp_path / "dead"))
    go()
    assert sorted(r.value for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["0", "1", "2", "4", "6", "once"]
    (dead,) = spark.read.parquet(str(tmp_path / "dead")).collect()
    assert dead.path.endswith("/in/3") and dead.attempts == 3 and "cannot read boom" in dead.error
    (tmp_path / "in/8").write_text("8\n")
    go()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 7 and spark.read.parquet(str(tmp_path / "dead")).count() == 1


def test_attempts_count_across_restarts(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a").write_text("a\n")
    go = lambda: process_new_files(spark, str(tmp_path / "in"), lambda lines: lines, str(tmp_path / "out"), str(tmp_path / "cp"), dead_letters=str(tmp_path / "dead"))

    def ends(self, paths, part):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as m:
        m.setattr(files._Batch, "run", ends)
        for _ in range(3):
            with pytest.raises(Exception, match="the driver is gone"):
                go()
    go()
    assert [(r.attempts, r.error) for r in spark.read.parquet(str(tmp_path / "dead")).collect()] == [(3, "ended the run")]
    assert not (tmp_path / "out").exists()


# archives


def test_records_by_index(spark, tmp_path):
    archives.register(spark)
    rows = [("response", f"http://a.example/{i}", "2020-01-02T03:04:05Z", "text/html", bytes([i % 251]) * (i * 37 % 5000) + b"\r\n\r\nWARC/1.0\r\n" + gzip.compress(b"WARC/1.0\r\nContent-Length: 0\r\n\r\n")) for i in range(300)] + [("request", None, None, None, b""), ("response", "http://a.example/none", None, None, None)]
    df = spark.createDataFrame(rows, "type string, uri string, ts string, mime string, content binary").coalesce(1)
    path = str(tmp_path / "w")
    df.write.format("warc").mode("append").save(path)
    (file,) = (tmp_path / "w").glob("*.warc.gz")
    records = spark.read.format("warc").load(path)
    found = records.collect()
    assert [(r.type, r.uri, r.ts, r.mime, bytes(r.content)) for r in found] == [(t, u, s, m, c or b"") for t, u, s, m, c in rows]
    raw = file.read_bytes()
    plain = gzip.decompress(raw)
    for r in found:
        assert plain[r.offset : r.offset + 5] == b"WARC/" and raw[r.member : r.member + 2] == b"\x1f\x8b" and gzip.decompress(raw[r.member :])[:100] == plain[r.offset :][:100]
    index = archives.index_records(records)
    index.write.parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    got = archives.fetch_records(index, task_bytes=20_000)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == [tuple(r) for r in found]
    assert got.select(F.spark_partition_id()).distinct().count() > 1  # one file, several tasks
    some = archives.fetch_records(index.where("uri like '%/1_' or uri like '%/29_'")).collect()
    assert {r.uri: bytes(r.content) for r in some} == {u: c for _, u, _, _, c in rows if u and len(u) in (19, 20) and (u[-2] == "1" and len(u) == 19 or u[-3:-1] == "29")}
    lost = archives.fetch_records(index.limit(1).withColumn("member", F.lit(5).cast("long")))
    assert lost.first().error == "no record there" and lost.count() == 1


def test_members_that_hold_several_records(spark, tmp_path):
    record = lambda i: b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nab%d\r\n\r\n" % i
    (tmp_path / "two.warc.gz").write_bytes(gzip.compress(record(1) + record(2)) + b"\0\0" + gzip.compress(record(3)))
    (tmp_path / "plain.warc").write_bytes(record(4) + record(5))
    archives.register(spark)
    got = {bytes(r.content): (r.offset, r.member) for r in spark.read.format("warc").load(str(tmp_path)).collect()}
    first = len(gzip.compress(record(1) + record(2)))
    n = len(record(1))
    assert got == {b"ab1": (0, 0), b"ab2": (n, None), b"ab3": (2 * n, first + 2), b"ab4": (0, 0), b"ab5": (n, n)}
    index = archives.index_records(spark.read.format("warc").load(str(tmp_path)))
    assert {bytes(r.content) for r in archives.fetch_records(index).collect()} == {b"ab1", b"ab3", b"ab4", b"ab5"}


def test_arc_records_by_index(spark, tmp_path):
    record = lambda i: b"http://a/%d 1.2.3.4 20200102030405 text/html 4\nab%02d\n" % (i, i)
    (tmp_path / "x.arc.gz").write_bytes(b"".join(gzip.compress(record(i)) for i in range(30)))
    archives.register(spark)
    index = archives.index_records(spark.read.format("arc").load(str(tmp_path)))
    got = archives.fetch_records(index, True, 300)
    assert sorted((r.uri, bytes(r.content)) for r in got.collect()) == sorted((f"http://a/{i}", b"ab%02d" % i) for i in range(30))


def test_filters_reach_the_reader(spark, tmp_path):
    archives.register(spark)
    spark.createDataFrame([(t, f"http://{h}/x", b"c") for t in ("response", "request") for h in "ab"], "type string, uri string, content binary").write.format("warc").mode("append").save(str(tmp_path / "w"))
    df = spark.read.format("warc").load(str(tmp_path / "w")).where("type = 'response' and uri like 'http://a%' and offset >= 0")
    assert [(r.type, r.uri) for r in df.collect()] == [("response", "http://a/x")]
    reader = archives._Reader({"path": str(tmp_path / "w")}, False)
    left = list(reader.pushFilters([archives.EqualTo(("type",), "response"), archives.EqualTo(("offset",), 1)]))
    assert len(left) == 1 and [r[5] for p in reader.partitions() for r in reader.read(p)] == ["http://a/x", "http://b/x"]


# sketches and state


def test_sketches_of_days(spark):
    rows = spark.range(60_000).selectExpr("id % 6 as day", "case when id % 10 < 3 then cast(sqrt(id % 900) as int) else 1000 + id end as k")
    sketches = profile.hitter_sketches(rows, "k", ["day"], 512)
    exact = {r.k: r.n for r in rows.groupBy("k").agg(F.count("*").alias("n")).collect()}
    error = profile.hitter_error(60_000, 512)
    merged = profile.merged_sketches(sketches, tracked=512)
    got = {r.k: r.n for r in profile.sketched_hitters(merged, "k", 512, tracked=512).collect()}
    above = {k for k, n in exact.items() if n > error}
    assert len(above) > 10 and above <= set(got) and all(abs(n - exact[k]) <= error for k, n in got.items())
    by_day = profile.sketched_hitters(sketches, "k", 2, ["day"], 512).groupBy("day").count().collect()
    assert {(r["day"], r["count"]) for r in by_day} == {(d, 2) for d in range(6)}
    assert profile.sketched_hitters(profile.merged_sketches(sketches.where("day > 9"), tracked=512), "k", 3, tracked=512).count() == 0
    few = profile.sketched_hitters(profile.hitter_sketches(rows.where("k < 30"), "k", tracked=512), "k", 100, tracked=512)
    assert {r.k: r.n for r in few.collect()} == {k: n for k, n in exact.items() if k < 30}


def test_domain_totals_of_a_stream(spark, tmp_path):
    from loomcrawl.streaming import domains

    rows = [(f"d{i % 5}.example", f"f{i % 3}", i % 7, i * 100) for i in range(10, 210)] + [("end", "f0", 0, 30_000), ("d1.example", "f0", 4, 40_000), ("end", "f0", 0, 400_000), ("later", "f0", 0, 800_000)]
    for k, part in enumerate((rows[:100], rows[100:200], *([r] for r in rows[200:]))):
        spark.createDataFrame(part, "domain string, format string, triples long, t long").withColumn("ts", F.timestamp_seconds("t")).drop("t").coalesce(1).write.parquet(str(tmp_path / f"in/{k:04d}"))
    spark.createDataFrame([("zz", "f0", 0, 1_600_000)], "domain string, format string, triples long, t long").withColumn("ts", F.timestamp_seconds("t")).drop("t").coalesce(1).write.parquet(str(tmp_path / "in/9999"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    domains.use_state(spark)
    try:
        stream = spark.readStream.schema("domain string, format string, triples long, ts timestamp").option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        out = domains.domain_totals(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        out.awaitTermination(100)
        assert not out.isActive
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    got = spark.read.schema(domains.TOTALS).parquet(str(tmp_path / "out"))
    want = Counter()
    for d, f, n, _ in rows:
        want[d, f, "triples"] += n
        want[d, f, "urls"] += 1
    sums = got.groupBy("domain", "format").agg(F.sum("triples").alias("triples"), F.sum("urls").alias("urls")).collect()
    assert {(r.domain, r.format): (r.triples, r.urls) for r in sums} == {(d, f): (want[d, f, "triples"], want[d, f, "urls"]) for d, f, _ in want}
    assert got.where("domain = 'd1.example'").count() > 3  # quiet for an hour, and back


# archives


def test_batches_of_records_end_by_bytes(tmp_path):
    path = tmp_path / "a.arc.gz"
    path.write_bytes(gzip.compress(b"".join(b"http://h/%d 192.0.2.1 20200102030405 text/html %d\n%s\nno header\n" % (k, 1 << 20, b"x" * (1 << 20)) for k in range(40))))
    reader = archives._Reader({"path": str(path), "tolerant": "true"}, True)
    got = list(reader.read(reader.partitions()[0]))
    assert max(b.nbytes for b in got) < 10 << 20 and len(got) == 5
    assert [u for b in got for u in b.column("uri").to_pylist()] == [f"http://h/{k}" for k in range(40)] and all(len(x) == 1 << 20 for b in got for x in b.column("content").to_pylist())


def test_members_are_unpacked_in_chunks():
    made = b"a" * (5 * archives.CHUNK + 3), b"", bytes(range(256)) * 9000, b"z"
    x = archives._Inflated(io.BytesIO(b"".join(map(gzip.compress, made)) + b"\0\0"))
    sizes, whole = [], b""
    while piece := x.read(archives.CHUNK * 64):
        sizes.append(len(piece))
        whole += piece
    assert whole == b"".join(made) and max(sizes) <= archives.CHUNK and not x.broken
    cut = archives._Inflated(io.BytesIO(gzip.compress(made[0])[:-900]))
    assert 0 < len(cut.readall()) <= len(made[0])


# corpus files


def test_damaged_files_are_told(spark, tmp_path):
    line = b'{"relation": [["a", "b"]], "url": "u"}\n'
    packed = gzip.compress(os.urandom(30_000).hex().encode() + b"\n" + line * 3)
    (tmp_path / "good.gz").write_bytes(gzip.compress(line * 2) + gzip.compress(b"no table\n"))
    (tmp_path / "cut.gz").write_bytes(gzip.compress(line) + packed[: len(packed) // 2])
    (tmp_path / "none.gz").write_bytes(b"")
    (tmp_path / "plain.gz").write_bytes(line)
    (tmp_path / "other.txt").write_bytes(line)
    got = {os.path.basename(r.file): (r.lines, r.error) for r in text.corpus_files(spark, str(tmp_path)).collect()}
    assert set(got) == {"good.gz", "cut.gz", "plain.gz"} and got["good.gz"] == (3, None)  # Spark lists no empty files
    assert got["cut.gz"][0] == 1 and "EOF" in got["cut.gz"][1] and got["plain.gz"][0] == 0 and "gzip" in got["plain.gz"][1]
    tables = text.table_corpus(spark, str(tmp_path)).collect()
    assert sum(r.dataset is not None for r in tables) == 3 and sum(r.dataset is None for r in tables) == 1


def test_lines_of_files_are_counted_where_they_are_read(spark, tmp_path):
    (tmp_path / "a.gz").write_bytes(gzip.compress(b"x\n" * (2 * text.LINES + 1)))
    (tmp_path / "b.gz").write_bytes(gzip.compress(b"x\n" * text.LINES))
    counted = text.corpus_files(spark, str(tmp_path))
    assert not re.search("Aggregate|Join|Sort", plan(counted).split("Physical Plan")[1])
    assert {(os.path.basename(r.file), r.lines, r.error) for r in counted.collect()} == {("a.gz", 2 * text.LINES + 1, None), ("b.gz", text.LINES, None)}


def test_terms_of_rows(spark):
    rows = [(1, "b a b The c's c d"), (1, "a"), (2, None), (3, ""), (4, "é É e x.y")]
    df = spark.createDataFrame(rows, "doc_id int, t string")
    got = [tuple(r) for r in relations.top_terms(df, "doc_id", "t", 2).collect()]
    assert sorted(got) == [(1, "b", 2), (1, "c", 2), (4, "e", 3), (4, "x.y", 1)]
    assert relations.top_terms(df.limit(0), "doc_id", "t").count() == 0


def test_shown_sizes(spark):
    shown = spark.createDataFrame([(1250,), (1280,), (999,), (1_250_000,)], "n long").select(human_bytes(F.col("n"), True).alias("si"), human_bytes(F.col("n")).alias("b")).collect()
    assert [(r.si, r.b) for r in shown] == [("1.3 kB", "1.2 KiB"), ("1.3 kB", "1.3 KiB"), ("999 B", "999 B"), ("1.3 MB", "1.2 MiB")]
