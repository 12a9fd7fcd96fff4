"""Structured data and tables from HTML, archives, streams, text sources and sinks."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from loomcrawl.functions.html_dom import parse
from loomcrawl.operators import postings, quads, structured_data as sd, web_tables
from loomcrawl.sources import archives, sinks, text
from loomcrawl.streaming import entities as stream_entities
from loomcrawl.streaming.files import process_new_files

S = "http://schema.org/"


def statements(html, *formats):
    rows = sd.extract_page(html, "http://h.example.org/p", list(formats))
    return {(s if not s.startswith("_:") else "_", p, o if not o.startswith("_:") else "_") for s, _, p, o, *_ in rows}


def test_dom():
    root = parse("<ul><li>a<li>b</ul><p>one<p>two<table><tr><td>1<td>2<tr><td>3</table><br>x<b>y</b>")
    assert [n.text() for n in root.find("li")] == ["a", "b"] and [n.text() for n in root.find("p")][:1] == ["one"]
    assert [[c.text() for c in r.find("td")] for r in root.find("tr")] == [["1", "2"], ["3"]]
    assert parse(None).text() == "" and parse("<a <b").text() is not None


def test_microdata():
    got = statements('<div itemscope itemtype="http://schema.org/Movie"><h1 itemprop="name">Avatar</h1><div itemprop="director" itemscope itemtype="http://schema.org/Person"><span itemprop="name">J C</span></div><a itemprop="trailer" href="../t.html">x</a><time itemprop="date" datetime="2009">y</time></div>', "html-microdata")
    assert {("_", quads.RDF_TYPE, S + "Movie"), ("_", S + "name", "Avatar"), ("_", S + "name", "J C"), ("_", S + "trailer", "http://h.example.org/t.html"), ("_", S + "date", "2009"), ("_", S + "director", "_")} <= got


def test_rdfa():
    F_ = sd.PREFIXES["foaf"]
    got = statements('<div xmlns:ex="http://ex/" about="#me" typeof="foaf:Person ex:T"><b property="foaf:name" content="N">x</b><i property="ex:a ex:b">v</i><a rel="foaf:knows" rev="ex:r" href="/y">y</a><u property="nope:z">q</u><p property="title">t</p><div rel="ex:has"><span about="/z" property="ex:n">m</span></div></div>', "html-rdfa")
    me = "http://h.example.org/p#me"
    assert {(me, quads.RDF_TYPE, F_ + "Person"), (me, quads.RDF_TYPE, "http://ex/T"), (me, F_ + "name", "N"), (me, "http://ex/a", "v"), (me, "http://ex/b", "v"), (me, F_ + "knows", "http://h.example.org/y"), ("http://h.example.org/y", "http://ex/r", me), (me, quads.XHTML + "title", "t"), (me, "http://ex/has", "http://h.example.org/z"), ("http://h.example.org/z", "http://ex/n", "m")} == got


def test_json_ld():
    doc = {"@context": {"@vocab": S, "ex": "http://ex/"}, "@id": "/me", "@type": ["Person", "ex:T"], "name": "N", "ex:n": 3, "knows": [{"@type": "Person", "name": "M"}, {"@value": "x", "@language": "en"}]}
    got = statements(f'<script type="application/ld+json">{json.dumps(doc)}</script><script type="application/ld+json">broken</script>', "rdf-jsonld")
    me = "http://h.example.org/me"
    assert got == {(me, quads.RDF_TYPE, S + "Person"), (me, quads.RDF_TYPE, "http://ex/T"), (me, S + "name", "N"), (me, "http://ex/n", "3"), (me, S + "knows", "_"), ("_", quads.RDF_TYPE, S + "Person"), ("_", S + "name", "M"), (me, S + "knows", "x")}


@pytest.mark.parametrize(
    "html,format,want",
    [
        ('<p class="geo"><abbr class="latitude" title="37.7">N</abbr><span class="longitude"><span class="value-title" title="-122.4"></span></span></p>', "html-mf-geo", {(sd.GEO + "latitude", "37.7"), (sd.GEO + "longitude", "-122.4")}),
        ('<p class="h-adr"><b class="p-locality">L</b></p>', "html-mf2-h-adr", {(sd.VCARD + "locality", "L")}),
        ('<p class="adr"><b class="locality">L</b></p>', "html-mf-adr", {(sd.VCARD + "locality", "L")}),
        ('<div class="vcard"><a class="email" href="mailto:a@b?s=1">m</a><b class="fn">F</b><p class="adr"><i class="region">R</i></p></div>', "html-mf-hcard", {(sd.VCARD + "email", "mailto:a@b"), (sd.VCARD + "fn", "F"), (sd.VCARD + "adr", "_"), (sd.VCARD + "region", "R")}),
        ('<div class="vevent"><b class="summary">S</b><abbr class="dtstart" title="2009">x</abbr></div>', "html-mf-hcalendar", {(sd.ICAL + "summary", "S"), (sd.ICAL + "dtstart", "2009")}),
        ('<div class="hlisting"><b class="price">5</b></div>', "html-mf-hlisting", {(sd.LISTING + "price", "5")}),
        ('<div class="hresume"><b class="summary">S</b><div class="contact vcard"><i class="fn">F</i></div></div>', "html-mf-hresume", {(sd.RESUME + "summary", "S"), (sd.RESUME + "contact", "_"), (sd.VCARD + "fn", "F")}),
        ('<div class="hreview"><b class="rating">4</b><p class="reviewer vcard"><i class="fn">F</i></p></div>', "html-mf-hreview", {(sd.REVIEW + "rating", "4"), (sd.REVIEW + "reviewer", "_"), (sd.VCARD + "fn", "F")}),
        ('<div class="hrecipe"><b class="fn">Pie</b><i class="ingredient">a</i></div>', "html-mf-hrecipe", {(sd.RECIPE + "fn", "Pie"), (sd.RECIPE + "ingredient", "a")}),
        ('<div class="species"><b class="binomial">P d</b></div>', "html-mf-species", {(sd.SPECIES + "binomial", "P d")}),
        ('<a rel="friend met" href="/f">f</a>', "html-mf-xfn", {(sd.XFN + "mePage", "http://h.example.org/p"), (sd.XFN + "friend-hyperlink", "http://h.example.org/f"), (sd.XFN + "met-hyperlink", "http://h.example.org/f")}),
    ],
)
def test_microformats(spark, html, format, want):
    got = {(p, o) for _, p, o in statements(html, format) if p != quads.RDF_TYPE}
    assert want <= got and len(got) <= len(want) + 2
    hints = spark.createDataFrame([(html,)], "h string").select(sd.guesses(F.col("h")).alias("g")).first().g
    assert format in hints


def test_pages_without_html(spark):
    pages = spark.createDataFrame([(None, None), ("", "u"), ("<p>", "u")], "html string, url string")
    assert sd.extract_quads(pages).count() == 0 and web_tables.extract_tables(pages).count() == 0


TABLE = "<table><caption>C</caption><tr><th>name<th>age</tr><tr><td>Anna<td>31</tr><tr><td>Bob<td>42</tr><tr><td><a href=x>Cid</a><td>53</tr></table>"


def test_tables(spark):
    html = {
        "good": f"<title>T</title><body><p>On 12-05-2010.<p>no</p>before words {TABLE} after <p>at 12:30</body>",
        "form": f"<form>{TABLE}</form>",
        "nested": f"<table><tr><td>{TABLE}</table>",
        "few": "<table><tr><td>a<td>b</table>",
        "one": "<table><tr><td>a<tr><td>b<tr><td>c</table>",
        "span": TABLE.replace("<td>Anna", "<td colspan=2>Anna"),
        "ragged": TABLE.replace("<td>42", "<td>42<td>43"),
        "sparse": "<table>" + "<tr><td><td>x<td>" * 4 + "</table>",
        "links": "<table>" + "<tr><td><a href=1>a</a><td><a href=2>b</a>" * 4 + "</table>",
    }
    t = web_tables.extract_tables(spark.createDataFrame(list(html.items()), "url string, html string"))
    why = {(r.url, r.table_no): r.w for r in t.select("url", "table_no", web_tables.reject_reason().alias("w")).collect()}
    assert why == {("good", 0): None, ("form", 0): "in_form", ("nested", 0): "nested", ("nested", 1): None, ("few", 0): "few_rows", ("one", 0): "few_columns", ("span", 0): "spans", ("ragged", 0): "ragged", ("sparse", 0): "sparse", ("links", 0): "link_list"}
    r = {x.url: x for x in web_tables.relations(t).collect()}["good"]
    assert (r.title, r.page_title, r.header_position, r.orientation, r.header_row, r.key_column) == ("C", "T", "FIRST_ROW", "HORIZONTAL", 0, -1)
    assert r.relation == [["name", "Anna", "Bob", "Cid"], ["age", "31", "42", "53"]] and r.before.endswith("before words") and r.after.startswith("after")
    assert len(r.time_before) == 1 and len(r.time_after) == 1
    f = {x.url: x for x in web_tables.features(t, ["url", "table_no"]).where("table_no = 0").collect()}["good"]
    assert (f.AVG_ROWS, f.AVG_COLS, f.MAX_COLS, f.STD_DEV_ROWS) == (4.0, 2.0, 2.0, 0.0) and f.LOCAL_RATIO_HEADER_ROW_0 == 1.0 and f.LOCAL_RATIO_IS_NUMBER_COL_1 == 0.75 and f.RATIO_DIGIT == 3 / 8
    assert f.LOCAL_RATIO_IS_NUMBER_COL_2 == 0.75 and f.LOCAL_AVG_LENGTH_ROW_2 == 2.5 and f.CUMULATIVE_CONTENT_CONSISTENCY == pytest.approx(2.0)


def test_grid_spans():
    rows = lambda h: web_tables._rows(parse(h).find("table")[0])
    grid = web_tables._grid(rows("<table><tr><td rowspan=2>a<td>b<td>c<tr><td colspan=2>d</table>"))
    assert [[c and c.text() for c in r] for r in grid] == [["a", "b", "c"], [None, "d", None]]
    assert web_tables._grid(rows("<table><tr><td rowspan=5>a<td>b<tr><td>c</table>")) is None and web_tables._grid(rows("<table><tr><td colspan=x>a</table>")) is None


def test_classifier(spark):
    rows = [(i, 0.9 if i % 2 else 0.1, "LAYOUT" if i % 2 else ("RELATION" if i % 4 else "ENTITY")) for i in range(80)]
    df = spark.createDataFrame(rows, "id int, v double, table_type string")
    names = list(dict.fromkeys(web_tables.PHASE_1 + web_tables.PHASE_2))
    df = df.select("id", "table_type", *(F.when(F.col("table_type") == "ENTITY", 1.0 - F.col("v")).otherwise(F.col("v")).alias(n) if n in web_tables.PHASE_2 and n not in web_tables.PHASE_1 else F.col("v").alias(n) for n in names))
    models = web_tables.train_classifiers(df)
    got = web_tables.classify(df.drop("table_type"), models).join(df.select("id", F.col("table_type").alias("truth")), "id")
    assert got.where("table_type <> truth").count() == 0


def warc(kind, uri, body):
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def http(kind, body):
    return f"HTTP/1.1 200 OK\r\nContent-Type: {kind}\r\nLast-Modified: Mon\r\n\r\n".encode() + body


def test_archives(spark, tmp_path):
    archives.register(spark)
    records = [warc("warcinfo", "", b"x"), warc("response", "http://a.example/1", http("text/html; charset=utf-8", "<p>é</p>".encode())), warc("response", "http://a.example/2", http("image/png", b"\x89")), warc("request", "http://a.example/1", b"GET"), warc("response", "nohost", http("text/html", b"x"))]
    (tmp_path / "w").mkdir()
    (tmp_path / "w/one.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    (tmp_path / "w/two.warc").write_bytes(b"junk\r\n" + records[1] + records[1][:-30])
    (tmp_path / "w/three.warc.gz").write_bytes(gzip.compress(records[1]) + gzip.compress(records[1])[:40])
    r = spark.read.format("warc").load(str(tmp_path / "w"))
    by = {x.f: x.n for x in r.groupBy(F.regexp_extract("file", "([a-z]+)[.]warc", 1).alias("f")).agg(F.count("*").alias("n")).collect()}
    assert by["one"] == 5 and by["two"] == 2 and by["three"] >= 1
    html = archives.html_responses(r).collect()
    assert {x.html for x in html} == {"<p>é</p>"} and {x.status for x in html} == {200} and {x.last_modified for x in html} == {"Mon"} and len(html) == 3
    assert archives.rejected_records(r).count() >= 1
    body = http("text/html", b"<p>arc</p>")
    arc = b"filedesc://x 0.0.0.0 20100101000000 text/plain 3\nabc\n" + f"http://b.example/ 1.2.3.4 20100101000000 text/html {len(body)}\n".encode() + body + b"\nnot a header\n" + f"http://c.example/ 1.2.3.4 20100101000000 text/html {len(body)}\n".encode() + body
    (tmp_path / "x.arc.gz").write_bytes(gzip.compress(arc))
    strict = spark.read.format("arc").load(str(tmp_path / "x.arc.gz"))
    assert strict.where("error is not null").count() == 1 and strict.count() == 3
    lenient = spark.read.format("arc").option("tolerant", True).load(str(tmp_path / "x.arc.gz"))
    assert {x.uri for x in archives.html_responses(lenient).collect()} == {"http://b.example/", "http://c.example/"}


def test_text_sources(spark, tmp_path):
    wat = {"Envelope": {"WARC-Header-Metadata": {"WARC-Type": "response", "WARC-Target-URI": "http://a/"}, "Payload-Metadata": {"HTTP-Response-Metadata": {"Headers": {"Content-Type": "text/html"}, "Response-Message": {"Status": "200"}, "HTML-Metadata": {"Links": [{"path": "A@/href", "url": "a\\b"}, {"path": "IMG@/src", "url": "i"}]}}}}}
    (tmp_path / "a.wat").write_text("WARC/1.0\n" + json.dumps(wat) + "\n{broken\n")
    from loomcrawl.operators.links import wat_adjacency

    assert [tuple(r) for r in wat_adjacency(text.wat(spark, str(tmp_path / "a.wat"))).collect()] == [("http://a/", ["a\\\\b"])]
    (tmp_path / "r.csv").write_text('"http://a/","' + json.dumps(wat).replace('"', '""') + '"\n')
    assert text.redirects(spark, str(tmp_path / "r.csv")).first().status == 200
    (tmp_path / "c/d").mkdir(parents=True)
    with gzip.open(tmp_path / "c/d/t.gz", "wt") as f:
        f.write('key\t{"relation": [["a", "1"]], "url": "u"}\n{"relation": [["b"]]}\nno table\n')
    (tmp_path / "c/bad.gz").write_bytes(b"\x1f\x8bbroken")
    got = text.table_corpus(spark, str(tmp_path / "c")).collect()
    assert sorted(len(r.dataset.relation) if r.dataset else 0 for r in got) == [0, 1, 1]
    (tmp_path / "seg").write_text("a\n\nb\na \n")
    assert {r.segment: r.place for r in text.segments(spark, str(tmp_path / "seg")).collect()} == {"a": 0, "b": 1}
    (tmp_path / "map").write_text("http://a/\tC\n")
    assert text.url_classes(spark, str(tmp_path / "map")).first().asDict() == {"url": "http://a/", "class": "C"}
    assert text.listing(spark, str(tmp_path), ".gz", 1).count() == 1
    (tmp_path / "l.csv").write_text('a,b\n"x ""q""",2\n"open,3\n4,5\n')
    assert [r.b for r in text.csv_lines(spark, str(tmp_path / "l.csv")).collect()][0] == "2"


def test_sinks(spark, tmp_path):
    rows = [("http://s", "iri", "http://p", "v", "literal", None, None, "http://g", e) for e in ("html-rdfa", "rdf-jsonld", "unknown")]
    q = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in quads.QUAD_COLUMNS))
    sinks.write_nquads(q, str(tmp_path / "nq"))
    assert text.nquads_series(spark, [str(tmp_path / "nq")] * 2).count() == 6
    sinks.write_by_extractor(q, str(tmp_path / "by"))
    assert sorted(p.name for p in (tmp_path / "by").glob("extractor=*")) == ["extractor=html-rdfa", "extractor=rdf-jsonld"]
    df = spark.createDataFrame([(2, "b c"), (1, "a b")], "id int, t string")
    sinks.write_csv(df.withColumnRenamed("id", "z"), str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).columns == ["t", "z"]
    sinks.write_text_index(df, str(tmp_path / "ix"), "id", {"t": F.col("t")})
    assert {r.doc_id for r in postings.lookup(postings.read_postings(spark, str(tmp_path / "ix")), "t", ["b"]).collect()} == {1, 2}
    sinks.write_key_value(df, str(tmp_path / "kv"), "id")
    assert json.loads(sinks.read_key_value(spark, str(tmp_path / "kv"), [2]).first().json) == {"id": 2, "t": "b c"}
    as_json, as_html = sinks.report({"T": df}, 1)
    assert json.loads(as_json)["T"] == [{"id": 2, "t": "b c"}] and "More rows" in as_html


def test_streaming_entities(spark, tmp_path):
    rows = [("d1", "e", quads.RDF_TYPE, "C", "iri", 0, 10), ("d1", "e", "in", "_:a", "bnode", 1, 11), ("d1", "_:a", "q", "v", "literal", 2, 12), ("d2", "f", quads.RDF_TYPE, "C", "iri", 3, 13), ("late", "x", "p", "o", "literal", 4, 100_000), ("end", "x", "p", "o", "literal", 5, 200_000)]
    schema = "graph string, s string, p string, o string, o_kind string, pos long, t long"
    for k, part in enumerate((rows[:2], rows[2:4], rows[4:5], rows[5:])):
        spark.createDataFrame(part, schema).withColumn("ts", F.timestamp_seconds("t")).drop("t").coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    files = spark.readStream.schema("graph string, s string, p string, o string, o_kind string, pos long, ts timestamp").option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = stream_entities.streaming_entities(files).writeStream.format("memory").queryName("ents").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r.graph, r.subject): r.props for r in spark.table("ents").collect()}
    assert got == {("d1", "e"): {quads.RDF_TYPE: "C", "q": "v"}, ("d2", "f"): {quads.RDF_TYPE: "C"}}


def test_files_are_worked_off_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    work = lambda b: b.select(F.expr("try_cast(value as int)").alias("n"), F.when(F.expr("try_cast(value as int)").isNull(), F.concat(F.lit("no number: "), "value")).alias("error"))
    go = lambda: process_new_files(spark, str(tmp_path / "in"), work, str(tmp_path / "out"), str(tmp_path / "cp"), str(tmp_path / "bad"))
    (tmp_path / "in/a").write_text("1\n2\nx\n")
    go()
    (tmp_path / "in/b").write_text("3\n")
    go()
    go()
    assert sorted(r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]
    assert [r.error for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["no number: x"]


def test_windowed_counts(spark, tmp_path):
    df = spark.createDataFrame([(k, s) for k, s in (("a", 1), ("a", 2), ("b", 400))], "k string, s long").select("k", F.timestamp_seconds("s").alias("ts"))
    got = {(r.window.start.minute, r.k): r.n for r in stream_entities.windowed_counts(df, "ts", "k").collect()}
    assert got == {(0, "a"): 2, (5, "b"): 1}


def test_jobs(spark, tmp_path):
    from loomcrawl.plans import jobs

    page = f'<body><div itemscope itemtype="http://schema.org/T"><b itemprop="name">N</b></div>{TABLE}</body>'
    records = [warc("response", f"http://a.example/{k}", http("text/html", page.encode())) for k in range(3)] + [warc("response", "http://a.example/x", http("text/html", b"<p>none"))]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, records)) + gzip.compress(records[0])[:60])
    source, out = str(tmp_path / "a.warc.gz"), str(tmp_path / "out")
    assert jobs.run("structured-data", spark, source, f"{out}/sd") == ["failures", "quads", "page_stats", "totals"]
    assert spark.read.parquet(f"{out}/sd/totals").first().asDict() == {"extractor": "html-microdata", "triples": 9, "urls": 3}
    assert spark.read.parquet(f"{out}/sd/page_stats").where("total_triples = 0").count() == 1
    assert text.nquads(spark, f"{out}/sd/quads").count() == 9
    jobs.run("tables", spark, source, f"{out}/t")
    (t,) = spark.read.json(f"{out}/t/tables").collect()
    assert t.relation[0] == ["name", "Anna", "Bob", "Cid"] and t.url == "http://a.example/0" and t.hasHeader
    assert {r.counter: r.n for r in spark.read.parquet(f"{out}/t/counters").collect()} == {"kept": 3}
    (tmp_path / "map").write_text("http://a.example/1\tC\n")
    jobs.lookup_job(spark, source, str(tmp_path / "map"), f"{out}/l")
    assert [r["class"] for r in spark.read.json(f"{out}/l/labelled").collect()] == ["C"]
    wat = lambda uri, refs: json.dumps({"Envelope": {"WARC-Header-Metadata": {"WARC-Type": "response", "WARC-Target-URI": uri}, "Payload-Metadata": {"HTTP-Response-Metadata": {"Headers": {"Content-Type": "text/html"}, "Response-Message": {"Status": "200"}, "HTML-Metadata": {"Links": [{"path": "A@/href", "url": r} for r in refs]}}}}})
    (tmp_path / "a.wat").write_text(wat("http://a/", ["/x", "http://b/"]) + "\n" + wat("http://b/", ["http://a/", "#f"]) + "\n")
    jobs.run("links", spark, str(tmp_path / "a.wat"), f"{out}/w")
    ids = {r.url: r.id for r in spark.read.parquet(f"{out}/w/index").collect()}
    assert ids == {"http://a/": 0, "http://a/x": 1, "http://b/": 2}
    assert {(r.origin, r.target) for r in spark.read.parquet(f"{out}/w/edges").collect()} == {(0, 1), (0, 2), (2, 0)}

    @jobs.job("mine")
    def mine(spark, source, out):
        return [source]

    assert jobs.run("mine", spark, "s", "o") == ["s"]


def test_iterate(spark):
    import pandas as pd

    from loomcrawl.plans.jobs import iterate

    got = iterate(spark.range(100).repartition(3), lambda b: pd.DataFrame({"k": ["rows"], "n": [len(b)]}), "k string, n long", lambda: pd.DataFrame({"k": ["tasks"], "n": [1]}))
    assert {r.k: r.n for r in got.groupBy("k").agg(F.sum("n").alias("n")).collect()} == {"rows": 100, "tasks": 3}
