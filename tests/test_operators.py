"""Operators on small inputs with known results."""

from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from loomcrawl.functions import text, typing, urls
from loomcrawl.operators import cooc, entities, links, profile, quads, relations
from loomcrawl.operators.ranks import dense_ids


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first().x


def test_resolve(spark):
    base = "http://h.example.org/a/b/c.html?x=1#f"
    refs = ["/x", "x", "../x", "../../x", "../../../x/", "./x", ".", "..", "?q=1", "//other/y", "x/./y/../z", "/a/../b", "y?q=../z", "https://k/z"]
    got = spark.createDataFrame([(r, base) for r in refs], "r string, b string").select("r", urls.resolve(F.col("r"), F.col("b")).alias("u")).collect()
    assert {r.r: r.u for r in got} == {r: urljoin(base, r) for r in refs}
    for bad in ("", "#f", "mailto:x@y", "javascript:0"):
        assert one(spark, urls.resolve(F.col("r"), F.col("b")), r=bad, b=base) is None
    assert one(spark, urls.resolve(F.col("r"), F.col("b")), r="/x", b="ftp://h/") is None


def test_domains(spark):
    cases = {"http://user:pw@Www.Example.co.uk:80/x": ("www.example.co.uk", "example.co.uk"), "https://a.b.example.com?x": ("a.b.example.com", "example.com"), "http://localhost/": ("localhost", None), "http://10.0.0.1/": ("10.0.0.1", None), "no url": ("no url", None)}
    got = spark.createDataFrame([(u,) for u in cases], "u string").select("u", urls.domain(F.col("u")).alias("d"), urls.registered_domain(F.col("u")).alias("r")).collect()
    assert {r.u: (r.d, r.r) for r in got} == cases
    assert one(spark, urls.path_terms(F.col("u")), u="http://h/some_long-title%20here/x.html") == ["some", "long", "title", "here", "x"]


def test_adjacency_text(spark):
    lines = spark.createDataFrame([("http://a/\t/x\thttp://b/\t#f\t",), ("http://c/",), ("\thttp://d/",), ("ftp://e/\t/x",)], "value string")
    got = {r.origin: r.links for r in links.clean_links(links.parse_adjacency(lines)).collect()}
    assert got == {"http://a/": ["http://a/x", "http://b/"]}


def test_dense_ids(spark):
    got = dense_ids(spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")), ["v"], "i").collect()
    assert len(got) == 1000 and all(r.v == r.i for r in got)


def test_quads_round_trip(spark):
    texts = ['plain "q" \\ back', "line\nfeed\ttab\r", "ünï ☃ \\u0041", "", "ends with \\"]
    rows = [("http://s", "iri", "http://p", t, "literal", None, None, "http://g", "html-rdfa") for t in texts]
    rows += [("_:b1", "bnode", "http://p", "_:b2", "bnode", None, None, "http://g", None), ("http://s", "iri", "http://p", "x", "literal", "en", None, "http://g", None), ("http://s", "iri", "http://p", "1", "literal", None, "http://d", "http://g", "e"), ("http://s", "iri", "http://p", "http://o", "iri", None, None, "http://g", "e")]
    q = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in quads.QUAD_COLUMNS))
    back = quads.parse_quads(quads.format_quads(q)).collect()
    assert sorted(map(repr, map(tuple, back))) == sorted(map(repr, rows))
    bad = spark.createDataFrame([("# c",), ("",), ('<http://s> <http://p> "cut',), ('<s> <p> "has <ex:html-rdfa> inside" <g> <ex:rdf-jsonld> .',)], "value string")
    assert [r.extractor for r in quads.parse_quads(bad).collect()] == ["rdf-jsonld"] and quads.broken_lines(bad).count() == 1
    assert one(spark, quads.unescape(F.col("t")), t="\\u00e9\\n\\'") == "é\n'"


def test_predicate_filter(spark):
    q = spark.createDataFrame([("http://bad/x",), ("http://bad/good/y",), ("http://ok/z",)], "p string")
    assert {r.p for r in quads.filter_predicates(q, ("http://bad/",), ("http://bad/good/",)).collect()} == {"http://bad/good/y", "http://ok/z"}


T = quads.RDF_TYPE
STATEMENTS = [
    ("e", T, "C", "iri", 0), ("e", "p", "1", "literal", 1), ("e", "p", "2", "literal", 2), ("e", "in", "_:a", "bnode", 3), ("_:a", "q", "deep1", "literal", 4), ("_:a", "in", "_:b", "bnode", 5),
    ("_:b", "r", "deep2", "literal", 6), ("_:b", "in", "_:c", "bnode", 7), ("_:c", "s", "deep3", "literal", 8), ("_:c", "in", "_:d", "bnode", 9), ("_:d", "t", "too deep", "literal", 10), ("x", "p", "no type", "literal", 11), ("_:c", "in", "_:c", "bnode", 12),
]


def test_entities(spark):
    q = spark.createDataFrame([(*r, "http://g/") for r in STATEMENTS], "s string, p string, o string, o_kind string, pos long, graph string")
    (e,) = entities.entities(q).collect()
    assert (e.url, e.context) == ("e", "http://g/") and e.props == {T: "C", "p": "2", "q": "deep1", "r": "deep2", "s": "deep3"}
    from loomcrawl.streaming.entities import assemble

    assert assemble(STATEMENTS) == [("e", e.props)]


def test_itemsets(spark):
    table = lambda rows: spark.createDataFrame(rows, "a string, b string, support long")
    pairs = table([("A", "B", 5), ("B", "C", 4), ("C", "A", 3), ("A", "D", 2), ("B", "D", 2), ("C", "D", 2), ("A", "A", 9)])
    got = {r["items"].replace(" ", ""): (r.support, r.share) for r in cooc.itemset_table(pairs, 10, 0, 2).collect()}
    assert got == {"AB": (5, 0.5), "BC": (4, 0.4), "ABC": (3, 0.3), "ABCD": (2, 0.2)}
    assert cooc.itemset_table(table([]), 10, 0).count() == 0 and cooc.itemset_table(table([("a", "a", 3)]), 10, 0).count() == 0
    assert {r["items"] for r in cooc.itemset_table(pairs, 10, 0.3).collect()} == {"A B", "B C", "A C"}  # grown sets must beat it


def test_cooc_domains(spark):
    items = spark.createDataFrame([(1, "a", "d1"), (1, "b", "d1"), (2, "a", "d2"), (2, "b", "d2"), (3, "a", "d1"), (3, "b", "d1"), (3, "c", "d1")], "basket int, key string, domain string")
    got = {(r.a, r.b): (r.support, [(t.domain, t.n) for t in r.top]) for r in cooc.pair_supports_with_domains(items, "basket", "key", "domain", 1).collect()}
    assert got[("a", "b")] == (3, [("d1", 2)]) and got[("b", "c")] == (1, [("d1", 1)])


def test_heavy_hitters_and_counters(spark):
    df = spark.createDataFrame([("a", 1), ("b", 5), ("a", 3), ("c", 4)], "k string, v int")
    assert [tuple(r) for r in profile.top_k(df, "k", F.col("v"), 2).collect()] == [("b", 5), ("a", 4)]
    assert {r.k for r in profile.top_k_lossy(df, "k", 1).collect()} == {"a"}
    c = spark.createDataFrame([("x", 1), ("y", 2)], "counter string, n long")
    assert {r.counter: r.n for r in profile.merge_counters(c, c).collect()} == {"x": 2, "y": 4}
    m = spark.createDataFrame([({"a": "1"},), ({"b": "2", "a": "3"},)], "m map<string,string>")
    assert {r.attribute for r in profile.attribute_union(m, "m").collect()} == {"a", "b"}


@pytest.mark.parametrize("cell,kind", [("", "none"), ("€5", "integer"), ("$1,000.50", "currency"), ("12.5 %", "double"), ("1234", "integer"), ("21343124124124€", "currency"), ("2131233213123123", "long"), ("about 5 of them", "string"), ("a", "string")])
def test_cell_types(spark, cell, kind):
    got = one(spark, typing.cell_type(F.col("c")), c=cell)
    assert got == kind or (cell == "€5" and got in ("string", "integer"))


def test_column_type_votes(spark):
    columns = {"mix": ["0.043", "123124124", "21343124124124€", "2131233213123123"], "most": ["1.5"] * 8 + ["x"], "empty": ["", ""], "words": ["a", "b", "1"] * 3}
    cells = spark.createDataFrame([(k, v) for k, vs in columns.items() for v in vs], "col string, cell string")
    got = {r.col: r.type for r in typing.column_types(cells, ["col"], "cell").collect()}
    assert got == {"mix": "double", "most": "double", "empty": "none", "words": "string"}


def test_patterns_and_text(spark):
    assert one(spark, typing.cell_pattern(F.col("c")), c="Ab 12-3 §x!") == "apdpdpsap"
    assert one(spark, text.terms(F.col("c")), c="The Café's dog, 3rd of U.S.A") == ["cafe", "dog", "3rd", "u.s.a"]
    assert one(spark, text.human_bytes(F.col("n")), n=1536) == "1.5 KiB" and one(spark, text.human_bytes(F.col("n"), True), n=1_500_000) == "1.5 MB" and one(spark, text.human_bytes(F.col("n")), n=12) == "12 B"
    assert one(spark, text.shorten(F.col("c")), c="x" * 101) == "x" * 100 + " ..."
    for t, want in {"on 12-05-2010, ok": True, "in May": True, "at 12:30": True, "44 BC": True, "5 o'clock": True, "maybe not": False, "room 12": False}.items():
        assert one(spark, text.has_time_expression(F.col("c")), c=t) == want


def test_relations(spark):
    rel = [["name", "Anna Lee", "Bob Ray", "Cid Poe"], ["age", "31", "42", "53"]]
    t = spark.createDataFrame([(1, rel), (2, rel), (3, [[c[0], c[1], c[2], "other"] for c in rel]), (4, [["one"], ["row"]]), (5, [["x", "1"], ["y", "2"]])], "id int, relation array<array<string>>")
    assert {r.id for r in relations.dedup_tables(t, "id").collect()} == {1, 4, 5}
    assert {r.id: r.s for r in t.select("id", relations.schema_text(F.col("relation")).alias("s")).collect()}[1] == "name,age"
    body = t.select("id", F.transform("relation", lambda c: F.slice(c, F.lit(2), F.size(c))).alias("relation"))
    key = {r.id: r.k for r in body.select("id", relations.key_column(F.col("relation")).alias("k")).collect()}
    assert key[1] == 0 and key[5] == -1
    head = {r.id: r.h for r in t.select("id", relations.header_row(F.col("relation")).alias("h")).collect()}
    assert head[1] == 0 and head[4] == -1
    assert relations.wide(t, 1).count() == 5 and relations.wide(t).count() == 0


def test_totals_make_entities_once(spark):
    rows = [("http://g1.org/", "u1", {"p": "http://g1.org/x", "q": "a", "r": "http://g2.org/y"}), ("http://g2.org/", "u2", {"p": "b"}), ("http://g2.org/", "u3", {"p": None})]
    ents = spark.createDataFrame(rows, "context string, url string, props map<string,string>")
    t = entities.totals(ents)
    assert t.first().asDict() == {"entities": 3, "domains": 2, "properties": 5, "links": 2, "remote_links": 1, "literals": 2}
    assert entities.totals(ents.limit(0)).first().asDict() == dict.fromkeys(("entities", "domains", "properties", "links", "remote_links", "literals"), 0)
    assert "Join" not in t._jdf.queryExecution().optimizedPlan().toString()
