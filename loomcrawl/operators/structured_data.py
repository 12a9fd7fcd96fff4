"""Structured data embedded in pages: a cheap prefilter, and statements from microdata, RDFa, JSON-LD and microformats.

The prefilter runs in the JVM, so only pages with a chance of statements reach Python; there a page is
parsed once for all formats.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcrawl.functions.html_dom import Node, parse
from loomcrawl.operators.quads import QUAD_COLUMNS, RDF_TYPE, XHTML

# What each format's markup looks like, in order; the last two are ours, as nothing else finds addresses.
GUESSERS = {
    "html-rdfa": r"(property|typeof|about|resource)\s*=",
    "html-microdata": r"(itemscope|itemprop\s*=)",
    "rdf-jsonld": r"ld\+json",
    "html-mf-geo": r"class\s*=\s*(\"|')[^\"']*geo",
    "html-mf-species": r"class\s*=\s*(\"|')[^\"']*species",
    "html-mf-xfn": r"<a[^>]*rel\s*=\s*(\"|')[^\"']*(contact|acquaintance|friend|met|co-worker|colleague|co-resident|neighbor|child|parent|sibling|spouse|kin|muse|crush|date|sweetheart|me)",
    "html-mf-hcalendar": r"(vcalendar|vevent)",
    "html-mf-hcard": r"vcard",
    "html-mf-hlisting": r"hlisting",
    "html-mf-hresume": r"hresume",
    "html-mf-hreview": r"hreview",
    "html-mf-hrecipe": r"hrecipe",
    "html-mf-adr": r"class\s*=\s*(\"|')[^\"']*\badr\b",
    "html-mf2-h-adr": r"class\s*=\s*(\"|')[^\"']*\bh-adr\b",
}
_FORMATS = r"((text/(rdf\+nq|nq|nquads|n-quads|nt|ntriples|rdf|rdf\+xml|rdf\+n3|n3|turtle))|(application/(rdf\+xml|rdf|n3|x-turtle|turtle)))"
FORMAT_GUESSERS = {"script-data": rf"<script[^>]*type\s*=\s*(\"|'){_FORMATS}", "link-data": rf"<link[^>]*type\s*=\s*(\"|'){_FORMATS}"}
VCARD, ICAL, GEO, REVIEW, XFN = "http://www.w3.org/2006/vcard/ns#", "http://www.w3.org/2002/12/cal/icaltzd#", "http://www.w3.org/2003/01/geo/wgs84_pos#", "http://purl.org/stuff/rev#", "http://vocab.sindice.com/xfn#"
RECIPE, LISTING, RESUME, SPECIES, META = (f"http://microformats.org/profile/{x}#" for x in ("hrecipe", "hlisting", "hresume", "species", "meta"))
XFN_WORDS = "contact acquaintance friend met co-worker colleague co-resident neighbor child parent sibling spouse kin muse crush date sweetheart me".split()
XHTML_WORDS = "alternate appendix bookmark chapter cite contents copyright first glossary help icon index last license meta next p3pv1 prev role section start stylesheet subsection up".split()
PREFIXES = {"rdf": RDF_TYPE[:-4], "rdfs": "http://www.w3.org/2000/01/rdf-schema#", "dc": "http://purl.org/dc/terms/", "foaf": "http://xmlns.com/foaf/0.1/", "schema": "http://schema.org/", "v": "http://rdf.data-vocabulary.org/#", "xhv": XHTML}
#: Graphs beyond this many statements are cut nowhere; it only bounds a JSON-LD tree's depth.
MAX_NESTING = 64


def guesses(html: Column) -> Column:
    """Formats whose markup a page may hold, in the order of GUESSERS."""
    return F.filter(F.array(*(F.when(html.rlike(f"(?i){p}"), n) for n, p in GUESSERS.items())), lambda x: x.isNotNull())


def any_guess(html: Column) -> Column:
    """True if a page may hold statements of any format."""
    return F.coalesce(html.rlike("(?i)" + "|".join(f"(?:{p})" for p in (*FORMAT_GUESSERS.values(), *GUESSERS.values()))), F.lit(False))


class _Statements:
    """Statements of one page: (s, s_kind, p, o, o_kind, o_lang, o_dtype), blank nodes numbered."""

    def __init__(self, url: str):
        self.url, self.rows, self.n = url, [], 0

    def blank(self) -> tuple[str, str]:
        self.n += 1
        return f"_:b{self.n}", "bnode"

    def iri(self, ref: str) -> tuple[str, str]:
        try:
            return urljoin(self.url, ref.strip()), "iri"
        except ValueError:
            return ref.strip(), "iri"

    def add(self, s: tuple[str, str], p: str, o: tuple[str, str], lang: str | None = None, dtype: str | None = None) -> None:
        if p and (o[0] or o[1] == "literal"):
            self.rows.append((*s, p, *o, lang, dtype))

    def text(self, s: tuple[str, str], p: str, value: str, lang: str | None = None, dtype: str | None = None) -> None:
        if value:
            self.add(s, p, (value, "literal"), lang, dtype)


def _lang(n: Node) -> str | None:
    for a in (n, *n.ancestors()):
        if v := a.attrs.get("lang") or a.attrs.get("xml:lang"):
            return v.lower()
    return None


_LINKED = {"a": "href", "area": "href", "link": "href", "audio": "src", "embed": "src", "iframe": "src", "img": "src", "source": "src", "track": "src", "video": "src", "object": "data"}


def microdata(root: Node, out: _Statements) -> None:
    """Items with their types and properties; items inside a property are its value."""

    def value(n: Node, of: tuple[str, str], p: str) -> None:
        if "itemscope" in n.attrs:
            out.add(of, p, item(n))
        elif n.tag == "meta":
            out.text(of, p, n.attrs.get("content", ""), _lang(n))
        elif n.tag in _LINKED:
            out.add(of, p, out.iri(n.attrs.get(_LINKED[n.tag], "")))
        elif n.tag == "time":
            out.text(of, p, n.attrs.get("datetime") or n.text())
        elif n.tag in ("data", "meter"):
            out.text(of, p, n.attrs.get("value") or n.text())
        else:
            out.text(of, p, n.attrs.get("content") or n.text(), _lang(n))

    def item(n: Node) -> tuple[str, str]:
        s = out.iri(n.attrs["itemid"]) if n.attrs.get("itemid") else out.blank()
        types = n.words("itemtype")
        for t in types:
            out.add(s, RDF_TYPE, (t, "iri"))
        vocab = re.sub(r"[^/#]*$", "", types[0]) if types else XHTML
        refs = set(n.words("itemref"))
        more = [x for x in root.walk() if x.attrs.get("id") in refs] if refs else []

        def props(x: Node) -> None:
            for c in x.children:
                if isinstance(c, Node):
                    for p in c.words("itemprop"):
                        value(c, s, p if ":" in p else vocab + p)
                    if "itemscope" not in c.attrs:
                        props(c)

        props(n)
        for x in more:
            for p in x.words("itemprop"):
                value(x, s, p if ":" in p else vocab + p)
            props(x)
        return s

    for n in root.walk():
        if "itemscope" in n.attrs and "itemprop" not in n.attrs:
            out.add((out.url, "iri"), "http://www.w3.org/1999/xhtml/microdata#item", item(n))


def rdfa(root: Node, out: _Statements) -> None:
    """Statements from about, src, resource, href, typeof, rel, rev, property and content, with prefixes in scope.

    A name with an unknown prefix gives no statement. A name without one is of the XHTML vocabulary for
    property; for rel and rev only if that vocabulary has it; for typeof only with a vocabulary in scope.
    """

    def expand(name: str, scope: dict[str, str], kind: str) -> str | None:
        if name.startswith("[") and name.endswith("]"):
            name = name[1:-1]
        if ":" in name:
            prefix, _, rest = name.partition(":")
            if rest.startswith("//"):
                return name
            return scope[prefix.lower()] + rest if prefix.lower() in scope else None
        if scope.get(""):
            return scope[""] + name
        if kind == "property" or (kind in ("rel", "rev") and name.lower() in XHTML_WORDS):
            return XHTML + name
        return None

    def node(v: str, scope: dict[str, str]) -> tuple[str, str] | None:
        if v.startswith("[") and v.endswith("]"):
            v = v[1:-1]
            if v.startswith("_:"):
                return v, "bnode"
            found = expand(v, scope, "safe")
            return (found, "iri") if found else None
        return (v, "bnode") if v.startswith("_:") else out.iri(v)

    def visit(n: Node, subject: tuple[str, str], scope: dict[str, str], hanging: list[tuple[str, bool]]) -> None:
        a = n.attrs
        new = dict(scope)
        for k, v in a.items():
            if k.startswith("xmlns:"):
                new[k[6:].lower()] = v
        words = a.get("prefix", "").split()
        new |= {p[:-1].lower(): iri for p, iri in zip(words[::2], words[1::2]) if p.endswith(":")}
        if "vocab" in a:
            new[""] = a["vocab"]
        rel, rev = n.words("rel"), n.words("rev")
        link = next((node(a[k], new) for k in ("resource", "href") if k in a), None)
        here = next((node(a[k], new) for k in ("about", "src") if k in a), None)
        if here is None and link and not rel and not rev:
            here = link
        if here is None and a.get("typeof", "").strip():
            here = (out.url, "iri") if n.tag in ("html", "head", "body") else out.blank()
        own = here or subject
        for p, forward in hanging if here or "property" in a or rel or rev else []:
            out.add(subject if forward else own, p, own if forward else subject)
        if here or "property" in a or rel or rev:
            hanging = []
        for t in n.words("typeof"):
            if (full := expand(t, new, "typeof")) is not None:
                out.add(own, RDF_TYPE, (full, "iri"))
        forward = [p for w in rel if (p := expand(w, new, "rel"))]
        back = [p for w in rev if (p := expand(w, new, "rev"))]
        inner, left = own, list(hanging)
        if forward or back:
            if link:
                for p in forward:
                    out.add(own, p, link)
                for p in back:
                    out.add(link, p, own)
                inner = link
            else:
                left = [(p, True) for p in forward] + [(p, False) for p in back]
        for name in n.words("property"):
            p = expand(name, new, "property")
            if p is None or p.startswith("og:") or (n.tag == "meta" and name.startswith("og:")):
                continue
            dtype = expand(a["datatype"], new, "typeof") if a.get("datatype") else None
            out.text(own, p, a["content"] if "content" in a else n.text(), None if dtype else _lang(n), dtype)
        for c in n.children:
            if isinstance(c, Node):
                visit(c, inner, new, left)

    for c in root.children:
        if isinstance(c, Node):
            visit(c, (out.url, "iri"), dict(PREFIXES), [])


def json_ld(root: Node, out: _Statements) -> None:
    """Statements of JSON-LD scripts with inline contexts (vocabularies, prefixes, terms); remote contexts stand for their own IRI's namespace."""

    def load(context, scope: dict[str, str]) -> dict[str, str]:
        scope = dict(scope)
        for c in context if isinstance(context, list) else [context]:
            if isinstance(c, str):
                scope["@vocab"] = c.rstrip("/#") + "/"
            elif isinstance(c, dict):
                for k, v in c.items():
                    v = v.get("@id") if isinstance(v, dict) else v
                    if isinstance(v, str):
                        scope[k] = expand(v, scope) if not k.startswith("@") else v
        return scope

    def expand(name: str, scope: dict[str, str]) -> str:
        if name in scope and not name.startswith("@"):
            return scope[name]
        prefix, colon, rest = name.partition(":")
        if colon:
            return name if rest.startswith("//") or prefix not in scope else scope[prefix] + rest
        return scope.get("@vocab", "") + name if scope.get("@vocab") else ""

    def value(s: tuple[str, str], p: str, v, scope: dict[str, str], depth: int) -> None:
        if isinstance(v, list):
            for x in v:
                value(s, p, x, scope, depth)
        elif isinstance(v, dict):
            if "@value" in v:
                dtype = expand(v["@type"], scope) if isinstance(v.get("@type"), str) else None
                out.text(s, p, str(v["@value"]), v.get("@language"), dtype or None)
            elif "@list" in v or "@set" in v:
                value(s, p, v.get("@list", v.get("@set")), scope, depth)
            else:
                out.add(s, p, thing(v, scope, depth + 1))
        elif isinstance(v, bool):
            out.text(s, p, "true" if v else "false", None, "http://www.w3.org/2001/XMLSchema#boolean")
        elif isinstance(v, int):
            out.text(s, p, str(v), None, "http://www.w3.org/2001/XMLSchema#integer")
        elif isinstance(v, float):
            out.text(s, p, repr(v), None, "http://www.w3.org/2001/XMLSchema#double")
        elif isinstance(v, str):
            out.text(s, p, v, scope.get("@language"))

    def thing(v: dict, scope: dict[str, str], depth: int) -> tuple[str, str]:
        if "@context" in v:
            scope = load(v["@context"], scope)
        s = out.iri(v["@id"]) if isinstance(v.get("@id"), str) and not v["@id"].startswith("_:") else (v["@id"], "bnode") if isinstance(v.get("@id"), str) else out.blank()
        if depth > MAX_NESTING:
            return s
        for t in v.get("@type", []) if isinstance(v.get("@type"), list) else [v.get("@type")]:
            if isinstance(t, str) and (full := expand(t, scope)):
                out.add(s, RDF_TYPE, (full, "iri"))
        for k, x in v.items():
            if not k.startswith("@") and (p := expand(k, scope)):
                value(s, p, x, scope, depth)
        for x in v.get("@graph", []) if isinstance(v.get("@graph"), list) else []:
            if isinstance(x, dict):
                thing(x, scope, depth + 1)
        return s

    for n in root.find("script"):
        if "ld+json" in n.attrs.get("type", "").lower():
            try:
                data = json.loads("".join(c for c in n.children if isinstance(c, str)))
            except (ValueError, RecursionError):
                continue
            for v in data if isinstance(data, list) else [data]:
                if isinstance(v, dict):
                    thing(v, {}, 0)


def _content(n: Node) -> str:
    """A microformat value: value-class parts, an abbreviation's title, a date, a link's alternative text, or the text."""
    parts = [x.attrs.get("title", "") if x.has_class("value-title") else x.attrs.get("title") or x.text() if x.tag == "abbr" else x.text() for x in n.by_class("value", "value-title")]
    if parts:
        return " ".join(filter(None, parts))
    if n.tag == "abbr" and n.attrs.get("title"):
        return n.attrs["title"]
    if n.tag in ("time", "ins", "del") and n.attrs.get("datetime"):
        return n.attrs["datetime"]
    if n.tag in ("img", "area") and n.attrs.get("alt"):
        return n.attrs["alt"]
    if n.tag in ("data", "input") and n.attrs.get("value"):
        return n.attrs["value"]
    return n.text()


def _link(n: Node, out: _Statements) -> tuple[str, str] | None:
    ref = n.attrs.get("href") or n.attrs.get("src") or n.attrs.get("data")
    if not ref:
        return None
    return (ref.split("?")[0], "iri") if ref.startswith(("mailto:", "tel:")) else out.iri(ref)


#: name -> (root classes, type, namespace, text properties, link properties, nested formats by class).
MICROFORMATS: dict[str, tuple[tuple[str, ...], str, str, tuple[str, ...], tuple[str, ...], dict[str, str]]] = {
    "html-mf-geo": (("geo",), GEO + "Point", GEO, ("latitude", "longitude"), (), {}),
    "html-mf-adr": (("adr",), VCARD + "Address", VCARD, ("post-office-box", "extended-address", "street-address", "locality", "region", "postal-code", "country-name"), (), {}),
    "html-mf2-h-adr": (("h-adr", "p-adr"), VCARD + "Address", VCARD, tuple(f"p-{x}" for x in ("post-office-box", "extended-address", "street-address", "locality", "region", "postal-code", "country-name", "latitude", "longitude")), (), {}),
    "html-mf-hcard": (("vcard",), VCARD + "VCard", VCARD, ("fn", "given-name", "family-name", "additional-name", "honorific-prefix", "honorific-suffix", "nickname", "bday", "rev", "tz", "category", "title", "role", "note", "class", "uid", "organization-name", "organization-unit", "org", "tel", "sort-string"), ("url", "email", "photo", "logo", "sound", "key"), {"adr": "html-mf-adr", "geo": "html-mf-geo"}),
    "html-mf-hcalendar": (("vevent", "vtodo", "vjournal"), ICAL + "Vevent", ICAL, ("summary", "dtstart", "dtend", "duration", "location", "description", "category", "status", "class", "uid", "dtstamp", "rdate", "rrule"), ("url", "attach"), {"organizer": "html-mf-hcard", "attendee": "html-mf-hcard"}),
    "html-mf-hlisting": (("hlisting",), LISTING + "Listing", LISTING, ("version", "listing", "dtlisted", "dtexpired", "price", "item", "fn", "summary", "description", "tags", "action", "offer", "sell", "rent", "trade", "meet", "announce", "wanted", "event", "service"), ("permalink", "photo", "url"), {"lister": "html-mf-hcard"}),
    "html-mf-hresume": (("hresume",), RESUME + "Resume", RESUME, ("summary", "skill", "affiliation", "publication", "education", "experience"), (), {"contact": "html-mf-hcard", "vevent": "html-mf-hcalendar"}),
    "html-mf-hreview": (("hreview",), REVIEW + "Review", REVIEW, ("version", "summary", "type", "dtreviewed", "rating", "description", "fn"), ("permalink", "url"), {"reviewer": "html-mf-hcard"}),
    "html-mf-species": (("species", "biota"), SPECIES + "species", SPECIES, ("binomial", "trinomial", "authority", "family", "genus", "order", "kingdom", "phylum", "common-name", "vernacular"), (), {}),
    "html-mf-hrecipe": (("hrecipe",), RECIPE + "Recipe", RECIPE, ("fn", "ingredient", "yield", "instructions", "duration", "summary", "published", "nutrition", "tag"), ("photo",), {"author": "html-mf-hcard"}),
}


def microformat(name: str) -> Callable[[Node, _Statements], None]:
    roots, kind, namespace, texts, links, nested = MICROFORMATS[name]

    def read(n: Node, out: _Statements) -> tuple[str, str] | None:
        s, before = out.blank(), len(out.rows)
        inside = {id(x) for r in n.walk() if r.has_class(*roots) and r is not n for x in r.walk()}
        for c in n.walk():
            if id(c) in inside:
                continue
            for w in c.words("class"):
                if w in nested:
                    inner = nested[w]
                    root = c if c.has_class(*MICROFORMATS[inner][0]) else None
                    o = microformat_item(inner, root, out) if root is not None else None
                    if o:
                        out.add(s, namespace + w, o)
                    elif root is None:
                        out.text(s, namespace + w, _content(c))
                elif w in texts:
                    out.text(s, namespace + w.removeprefix("p-"), _content(c))
                elif w in links:
                    o = _link(c, out)
                    out.add(s, namespace + w, o) if o else out.text(s, namespace + w, _content(c))
        if not links and not nested and len(out.rows) == before and name == "html-mf-geo" and ";" in (value := _content(n)):
            for p, v in zip(texts, value.split(";")):
                out.text(s, namespace + p, v.strip())
        if len(out.rows) == before:
            return None
        out.rows.insert(before, (*s, RDF_TYPE, kind, "iri", None, None))
        return s

    def run(root: Node, out: _Statements) -> None:
        for n in root.walk():
            if n.has_class(*roots):
                read(n, out)

    run.read = read
    return run


def microformat_item(name: str, n: Node, out: _Statements) -> tuple[str, str] | None:
    return microformat(name).read(n, out)


def xfn(root: Node, out: _Statements) -> None:
    """Relations of people from a's rel values."""
    me = None
    for n in root.find("a"):
        found = [w for w in n.words("rel") if w.lower() in XFN_WORDS]
        if found and n.attrs.get("href"):
            if me is None:
                me = out.blank()
                out.add(me, XFN + "mePage", (out.url, "iri"))
            for w in found:
                out.add(me, XFN + w.lower() + "-hyperlink", out.iri(n.attrs["href"]))


def head_meta(root: Node, out: _Statements) -> None:
    """Named meta elements of the head as statements on the document; not part of EXTRACTORS_OF unless asked for."""
    lang = next((n.attrs.get("lang") for n in root.find("html")), None)
    for n in root.find("meta"):
        if n.attrs.get("name") and n.attrs.get("content"):
            out.text((out.url, "iri"), META + n.attrs["name"].strip().replace(" ", "_"), n.attrs["content"], lang)


EXTRACTORS_OF: dict[str, Callable[[Node, _Statements], None]] = {"html-rdfa": rdfa, "html-microdata": microdata, "rdf-jsonld": json_ld, **{n: microformat(n) for n in MICROFORMATS}, "html-mf-xfn": xfn}


def extract_page(html: str, url: str, formats: list[str]) -> list[tuple]:
    """Quads of one page, columns as QUAD_COLUMNS; a format that fails gives none."""
    root, out = parse(html), []
    for f in formats:
        statements = _Statements(url)
        try:
            EXTRACTORS_OF[f](root, statements)
        except RecursionError:
            continue
        out += [(s, sk, p, o, ok, lang, dtype, url, f) for s, sk, p, o, ok, lang, dtype in statements.rows]
    return out


def extract_quads(pages: DataFrame, html: str = "html", url: str = "url", formats: tuple[str, ...] = tuple(EXTRACTORS_OF)) -> DataFrame:
    """Quads of all pages, for the formats their markup hints at. Blank nodes are unique within a page and a format."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 200):
                part = b.slice(k, 200)
                rows = [q for h, u, g in zip(*(c.to_pylist() for c in part.columns)) for q in extract_page(h, u or "", [f for f in g if f in formats])]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (zip(*rows) if rows else [[]] * 9)], QUAD_COLUMNS)

    hinted = pages.where(any_guess(F.col(html))).select(F.col(html).alias("html"), F.col(url).alias("url"), guesses(F.col(html)).alias("g")).where(F.size("g") > 0)
    return hinted.mapInArrow(run, ", ".join(f"{c} string" for c in QUAD_COLUMNS))


def page_statistics(pages: DataFrame, quads: DataFrame, url: str = "url") -> DataFrame:
    """(uri, referenced, triples by extractor as a map, total_triples), one row per page; pages without statements have an empty map."""
    by = quads.groupBy("graph", "extractor").agg(F.count("*").alias("n")).groupBy("graph").agg(F.map_from_entries(F.collect_list(F.struct("extractor", "n"))).alias("triples"), F.sum("n").alias("total_triples"))
    p = pages.select(F.col(url).alias("uri"), guesses(F.col("html")).alias("referenced")).join(by, F.col("uri") == F.col("graph"), "left")
    return p.select("uri", "referenced", F.coalesce("triples", F.expr("cast(map() as map<string, bigint>)")).alias("triples"), F.coalesce("total_triples", F.lit(0)).alias("total_triples"))


def guessed_without_triples(stats: DataFrame) -> DataFrame:
    return stats.where((F.size("referenced") > 0) & (F.col("total_triples") == 0))


# Queries: pages with one constructed snippet each; raw pages hold no markup.

SNIPPETS = [
    '<div itemscope itemtype="http://schema.org/Movie"><span itemprop="name">N{}</span><div itemprop="director" itemscope itemtype="http://schema.org/Person"><b itemprop="name">D</b></div><a itemprop="trailer" href="/t{}">t</a></div>',
    '<div about="/me{}" typeof="foaf:Person"><span property="foaf:name">P{}</span><a rel="foaf:knows" href="/x">x</a></div>',
    '<script type="application/ld+json">{{"@context": "http://schema.org", "@type": "Event", "name": "E{}", "location": {{"@type": "Place", "name": "L{}"}}}}</script>',
    '<div class="vcard"><b class="fn">V{}</b><a class="url" href="/v{}">w</a></div>',
    '<div class="geo"><i class="latitude">1.{}</i><i class="longitude">2.{}</i></div>',
    '<div class="vevent"><b class="summary">S{}</b><i class="dtstart">2010-{}</i></div>',
    '<a rel="friend met" href="/f{}">f{}</a>',
    "<p>no markup {} {}</p>",
]


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spark.read.parquet(f"{sf_dir}/pages.parquet")
    i = F.col("page_id").cast("string")
    made = F.element_at(F.array(*map(F.lit, SNIPPETS)), (F.col("page_id") % len(SNIPPETS) + 1).cast("int"))
    html = F.replace(F.replace(F.replace(made, F.lit("{}"), i), F.lit("{{"), F.lit("{")), F.lit("}}"), F.lit("}"))
    page = F.concat(F.lit("<html><body>"), html, F.lit("</body></html>"))
    return p.select("page_id", F.concat(F.lit("http://m.example.org/"), i).alias("url"), page.alias("html")).unionByName(p.select("page_id", "url", "html"))


def guesser_prefilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _marked(spark, sf_dir).where(any_guess(F.col("html"))).select("page_id", F.array_join(guesses(F.col("html")), " ").alias("formats"))
    return g.groupBy("formats").agg(F.count("*").alias("pages"))


def statement_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = extract_quads(_marked(spark, sf_dir))
    return q.groupBy("extractor", "p", "o_kind").agg(F.count("*").alias("quads"), F.countDistinct("graph").alias("pages"))


def page_statement_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _marked(spark, sf_dir)
    s = page_statistics(pages, extract_quads(pages))
    return s.groupBy("total_triples").agg(F.count("*").alias("pages"))


QUERIES = {f.__name__: f for f in (guesser_prefilter, statement_counts, page_statement_totals)}
_N = "n as (select page_id % 8 as k, count(*) as pages from pages group by 1)"
_S = "http://schema.org/"
_WANT = [
    (0, "html-microdata", "http://www.w3.org/1999/xhtml/microdata#item", "bnode", 1), (0, "html-microdata", RDF_TYPE, "iri", 2), (0, "html-microdata", _S + "name", "literal", 2), (0, "html-microdata", _S + "director", "bnode", 1), (0, "html-microdata", _S + "trailer", "iri", 1),
    (1, "html-rdfa", RDF_TYPE, "iri", 1), (1, "html-rdfa", PREFIXES["foaf"] + "name", "literal", 1), (1, "html-rdfa", PREFIXES["foaf"] + "knows", "iri", 1),
    (2, "rdf-jsonld", RDF_TYPE, "iri", 2), (2, "rdf-jsonld", _S + "name", "literal", 2), (2, "rdf-jsonld", _S + "location", "bnode", 1),
    (3, "html-mf-hcard", RDF_TYPE, "iri", 1), (3, "html-mf-hcard", VCARD + "fn", "literal", 1), (3, "html-mf-hcard", VCARD + "url", "iri", 1),
    (4, "html-mf-geo", RDF_TYPE, "iri", 1), (4, "html-mf-geo", GEO + "latitude", "literal", 1), (4, "html-mf-geo", GEO + "longitude", "literal", 1),
    (5, "html-mf-hcalendar", RDF_TYPE, "iri", 1), (5, "html-mf-hcalendar", ICAL + "summary", "literal", 1), (5, "html-mf-hcalendar", ICAL + "dtstart", "literal", 1),
    (6, "html-mf-xfn", XFN + "mePage", "iri", 1), (6, "html-mf-xfn", XFN + "friend-hyperlink", "iri", 1), (6, "html-mf-xfn", XFN + "met-hyperlink", "iri", 1),
]
_VALUES = ", ".join(f"({k}, '{e}', '{p}', '{o}', {n})" for k, e, p, o, n in _WANT)
ORACLE_SQL = {
    "guesser_prefilter": f"with {_N} select f as formats, pages from n join (values (0, 'html-microdata'), (1, 'html-rdfa'), (2, 'rdf-jsonld'), (3, 'html-mf-hcard'), (4, 'html-mf-geo'), (5, 'html-mf-hcalendar'), (6, 'html-mf-xfn')) v(k, f) using (k)",
    "statement_counts": f"with {_N} select e as extractor, p, o as o_kind, (pages * m)::bigint as quads, pages from n join (values {_VALUES}) v(k, e, p, o, m) using (k)",
    "page_statement_totals": f"""with {_N}, t as (select k, sum(m)::bigint as m from (values {_VALUES}) v(k, e, p, o, m) group by 1),
        x as (select coalesce(m, 0) as total_triples, pages from n left join t using (k) union all select 0, count(*) from pages)
        select total_triples, sum(pages)::bigint as pages from x group by 1""",
}
