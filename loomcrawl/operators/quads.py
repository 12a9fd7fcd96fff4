"""N-Quads with an extractor as fifth term: text to columns and back, split by extractor, filters on predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcrawl.operators.prefixes import abbreviate

# The extractors whose statements are told apart.
EXTRACTORS = (
    "html-rdfa", "html-rdfa11", "html-microdata", "html-mf-geo", "html-mf-hcalendar", "html-mf-hcard", "html-mf-adr", "html-mf2-h-adr",
    "html-mf-hlisting", "html-mf-hresume", "html-mf-hreview", "html-mf-species", "html-mf-hrecipe", "html-mf-xfn", "rdf-jsonld", "html-embedded-jsonld",
)
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
XHTML = "http://www.w3.org/1999/xhtml/vocab#"

_SUBJECT = r"(?:<([^<>]*)>|(_:\S+))"
_LITERAL = r'"((?:[^"\\]|\\.)*)"(?:@([A-Za-z0-9-]+)|\^\^<([^<>]*)>)?'
QUAD = rf"^\s*{_SUBJECT}\s+<([^<>]*)>\s+(?:<([^<>]*)>|(_:\S+)|{_LITERAL})\s+<([^<>]*)>\s*(?:<ex:([^<>]+)>)?\s*\.\s*$"
#: QUAD with the object's first sign as a group of its own, 4, before the others.
_PARTED = QUAD.replace(r">\s+(?:<([^<>]*)>|(_:", r">\s+(?=([<_\"]))(?:<([^<>]*)>|(_:", 1)
#: Stands in no part of a statement: IRIs have no >, names of blank nodes no space, and a literal no quotation mark without a backslash before it.
_BETWEEN = '> "<'
QUAD_COLUMNS = ["s", "s_kind", "p", "o", "o_kind", "o_lang", "o_dtype", "graph", "extractor"]


def escape(text: Column) -> Column:
    """A literal's text as N-Triples writes it."""
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def _short_escapes(text: Column) -> Column:
    r"""Text whose \UXXXXXXXX are characters, or \uXXXX where these do; null where one is no code point. An escaped backslash is \ afterwards."""
    parts = F.split(F.replace(text, F.lit("\\\\"), F.lit("\\u005C")), r"\\U")
    rest = lambda x: F.substring(x, F.lit(9), F.length(x))
    low = lambda x: F.concat(F.lit("\\u"), F.substring(x, F.lit(5), F.lit(4)), rest(x))
    high = lambda x: F.concat(F.decode(F.unhex(F.left(x, F.lit(8))), "UTF-32"), rest(x))
    one = lambda x: F.when(x.rlike("^0000[0-9A-Fa-f]{4}"), low(x)).when(x.rlike("^00(?:0[1-9A-Fa-f]|10)[0-9A-Fa-f]{4}"), high(x))
    return F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), F.element_at(parts, 1), lambda a, x: F.concat(a, one(x)))


def unescape(text: Column) -> Column:
    r"""The text of a literal; JSON has the same escapes, but for \' and \UXXXXXXXX. Null if an escape is broken."""
    short = F.when(text.contains("\\U"), _short_escapes(text)).otherwise(text)
    return F.when(text.contains("\\"), F.get_json_object(F.concat(F.lit('{"t":"'), F.replace(short, F.lit("\\'"), F.lit("'")), F.lit('"}')), "$.t")).otherwise(text)


def parse_quads(lines: DataFrame) -> DataFrame:
    """Quads from text lines (column value); comments, blank and broken lines are left out."""
    # a line is matched as a whole once, not once for each of its parts; behind explode, filters on a part do not match it again
    parts = F.split(F.regexp_replace("value", _PARTED, _BETWEEN.join(f"${k}" for k in range(1, 12))), F.lit(_BETWEEN))
    x = lines.select(F.explode(F.when(F.col("value").rlike(QUAD), F.array(parts))).alias("x"))
    g = lambda k: F.get("x", k - 1)
    filled = lambda c: F.when(c != "", c)
    kind = F.when(g(4) == "_", "bnode").when(g(4) == "<", "iri").otherwise("literal")
    return x.withColumn("o_kind", kind).select(
        F.coalesce(filled(g(1)), g(2)).alias("s"),
        F.when(g(2) != "", "bnode").otherwise("iri").alias("s_kind"),
        g(3).alias("p"),
        F.when(F.col("o_kind") == "literal", unescape(g(7))).when(F.col("o_kind") == "bnode", g(6)).otherwise(g(5)).alias("o"),
        "o_kind",
        filled(g(8)).alias("o_lang"),
        filled(g(9)).alias("o_dtype"),
        g(10).alias("graph"),
        filled(g(11)).alias("extractor"),
    )


def broken_lines(lines: DataFrame) -> DataFrame:
    """Lines that are neither quads nor comments nor blank."""
    return lines.where(~F.col("value").rlike(QUAD) & ~F.col("value").rlike(r"^\s*(#|$)"))


def format_quads(quads: DataFrame) -> DataFrame:
    """Text lines (column value) from quads."""
    node = lambda c, kind: F.when(kind == "bnode", c).otherwise(F.concat(F.lit("<"), c, F.lit(">")))
    tail = F.when(F.col("o_lang").isNotNull(), F.concat(F.lit("@"), "o_lang")).when(F.col("o_dtype").isNotNull(), F.concat(F.lit("^^<"), "o_dtype", F.lit(">"))).otherwise("")
    o = F.when(F.col("o_kind") == "literal", F.concat(F.lit('"'), escape(F.col("o")), F.lit('"'), tail)).otherwise(node(F.col("o"), F.col("o_kind")))
    ex = F.when(F.col("extractor").isNotNull(), F.concat(F.lit("<ex:"), "extractor", F.lit(">")))
    parts = [node(F.col("s"), F.col("s_kind")), F.concat(F.lit("<"), "p", F.lit(">")), o, F.concat(F.lit("<"), "graph", F.lit(">")), ex, F.lit(".")]
    return quads.select(F.concat_ws(" ", *parts).alias("value"))


def demux(quads: DataFrame, extractors: tuple[str, ...] = EXTRACTORS) -> DataFrame:
    """Quads of known extractors."""
    return quads.where(F.col("extractor").isin(*extractors))


def write_by_extractor(quads: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """gzip text below path/extractor=NAME, in files of at most rows_per_file lines; the extractor stays in the lines too."""
    lines = format_quads(demux(quads))
    ex = F.regexp_extract("value", r"<ex:([^<>]+)> \.$", 1)
    lines.withColumn("extractor", ex).write.partitionBy("extractor").option("maxRecordsPerFile", rows_per_file).option("compression", "gzip").text(path)


def filter_predicates(quads: DataFrame, negative: tuple[str, ...] = (XHTML,), positive: tuple[str, ...] = ()) -> DataFrame:
    """Without predicates of a negative namespace, unless one of a positive namespace too."""
    starts = lambda names: F.exists(F.array(*map(F.lit, names)), lambda n: F.col("p").startswith(n)) if names else F.lit(False)
    return quads.where(~starts(negative) | starts(positive))


# Queries: quads built from nation, customer and supplier, written as text and read back.

_BASE = "http://data.example.org/"


def _quad(s: Column, p: str, o: Column, kind: str, graph: Column, ex: Column, dtype: str | None = None) -> Column:
    return F.struct(s.alias("s"), F.lit("iri").alias("s_kind"), F.lit(p).alias("p"), o.cast("string").alias("o"), F.lit(kind).alias("o_kind"), F.lit(None).cast("string").alias("o_lang"), F.lit(dtype).cast("string").alias("o_dtype"), graph.alias("graph"), ex.alias("extractor"))


def _customers(spark: SparkSession, sf_dir: str, dealt: bool) -> DataFrame:
    """dealt: to as many tasks as a shuffle has; the file is small, often one row group, but the work on its lines is not."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return c.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))) if dealt else c


def _customer_quads(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Five quads per customer: type, name with a quote and a backslash, balance, nation, an unwanted predicate."""
    c = _customers(spark, sf_dir, dealt)
    s, graph = F.concat(F.lit(f"{_BASE}c/"), F.col("c_custkey").cast("string")), F.concat(F.lit("http://g"), (F.col("c_custkey") % 17).cast("string"), F.lit(".example.org/"))
    ex = F.element_at(F.array(F.lit("html-microdata"), F.lit("html-rdfa"), F.lit("rdf-jsonld"), F.lit("unknown-kind")), (F.col("c_custkey") % 4 + 1).cast("int"))
    rows = F.array(
        _quad(s, RDF_TYPE, F.lit(f"{_BASE}Customer"), "iri", graph, ex),
        _quad(s, f"{_BASE}name", F.concat(F.lit('"q\\'), "c_name", F.lit("\n")), "literal", graph, ex),
        _quad(s, f"{_BASE}balance", F.col("c_acctbal"), "literal", graph, ex, "http://www.w3.org/2001/XMLSchema#double"),
        _quad(s, f"{_BASE}nation", F.concat(F.lit(f"{_BASE}n/"), F.col("c_nationkey").cast("string")), "iri", graph, ex),
        _quad(s, f"{XHTML}stylesheet", F.lit("x.css"), "literal", graph, ex),
    )
    return c.select(F.explode(rows).alias("q")).select("q.*")


def _customer_lines(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    good = format_quads(_customer_quads(spark, sf_dir, dealt))
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return good.unionByName(c.where("c_custkey % 10 = 0").select(F.concat(F.lit('<http://x> <http://y> "cut off '), "c_name").alias("value"))).unionByName(c.where("c_custkey % 50 = 0").select(F.lit("# note").alias("value")))


def quad_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_quads(_customer_lines(spark, sf_dir, dealt=True)).where(F.col("p") == f"{_BASE}name").select("s", "o", "graph", "extractor")


def quad_demux(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = demux(parse_quads(_customer_lines(spark, sf_dir, dealt=True)))
    return q.groupBy("extractor", "o_kind").agg(F.count("*").alias("quads"), F.countDistinct("s").alias("subjects"))


def quad_ns_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = filter_predicates(parse_quads(_customer_lines(spark, sf_dir, dealt=True)))
    names = spark.createDataFrame([("d", _BASE), ("rdf", RDF_TYPE[:-4])], "prefix string, namespace string")
    return abbreviate(q.groupBy("p").agg(F.count("*").alias("quads")), "p", names, "predicate").drop("p")


def quad_escapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literals with short and long escapes of all planes, an escaped backslash before a U, and a long one that is no code point."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    made = F.array(*map(F.lit, (r"a\U0001F600b", r"é\U000000E9", r"\\U0001F600", r"q\U00000022\U0000005C", r"\U00110000", r"\U0010FFFD\t")))
    literal = F.concat(F.element_at(made, (F.col("c_custkey") % 6 + 1).cast("int")), F.col("c_custkey").cast("string"))
    return parse_quads(c.select(F.concat(F.lit('<http://s> <http://p> "'), literal, F.lit('" <http://g> .')).alias("value"))).select("o")


def quad_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return broken_lines(_customer_lines(spark, sf_dir))


QUERIES = {f.__name__: f for f in (quad_roundtrip, quad_demux, quad_ns_filter, quad_escapes, quad_quarantine)}
_EX = "['html-microdata', 'html-rdfa', 'rdf-jsonld', 'unknown-kind'][c_custkey % 4 + 1]"
ORACLE_SQL = {
    "quad_roundtrip": f"select '{_BASE}c/' || c_custkey as s, '\"q\\' || c_name || chr(10) as o, 'http://g' || (c_custkey % 17) || '.example.org/' as graph, {_EX} as extractor from customer",
    "quad_demux": f"""select {_EX} as extractor, k as o_kind, sum(n)::bigint as quads, count(distinct c_custkey) as subjects
        from customer, (values ('iri', 2), ('literal', 3)) v(k, n) where c_custkey % 4 < 3 group by 1, 2""",
    "quad_ns_filter": "select p as predicate, count(*) as quads from customer, (values ('rdf:type'), ('d:name'), ('d:balance'), ('d:nation')) v(p) group by 1",
    "quad_escapes": """select case c_custkey % 6 when 0 then 'a' || chr(128512) || 'b' when 1 then chr(233) || chr(233) when 2 then '\\U0001F600' when 3 then 'q"' || chr(92) when 4 then null else chr(1114109) || chr(9) end || c_custkey as o from customer""",
    "quad_quarantine": "select '<http://x> <http://y> \"cut off ' || c_name as value from customer where c_custkey % 10 = 0",
}
