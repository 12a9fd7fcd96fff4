"""Entities from quads: assembly with nested blank nodes, class and property statistics, tables of entities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcrawl.functions.urls import domain
from loomcrawl.operators.quads import RDF_TYPE
from loomcrawl.operators.scratch import saved

#: Blank nodes below an entity are merged down to this depth.
MAX_DEPTH = 3
VCARD = "http://www.w3.org/2006/vcard/ns#"


def entity_statements(quads: DataFrame, depth: int = MAX_DEPTH) -> DataFrame:
    """(graph, subject, p, pos, o, kind, typed): statements of each subject that has no blank node as value, and those of blank nodes that it holds.

    An entity is a subject of a graph with a row that is `typed`: an rdf:type of its own, with a null kind if its value is a blank
    node. quads need a column pos, their place in the input, and are read for each part of the work: save them where they are costly
    to make. References between blank nodes are followed first, as names alone, so that statements of blank nodes move once whatever
    the depth is, and all others not at all. A blank node that several subjects hold is merged into each of them, and one
    beyond `depth` contributes nothing.
    """
    is_ref, is_type = F.col("o_kind") == "bnode", F.coalesce(F.col("p") == RDF_TYPE, F.lit(False))
    # names of blank nodes begin so, and no others
    blank = lambda c: F.coalesce(F.col(c).startswith("_:"), F.lit(False))
    statements = lambda subject, *typed: [F.col("graph"), subject.alias("subject"), "p", "pos", "o", F.col("o_kind").alias("kind"), *typed]
    own = quads.where(~is_ref & ~blank("s")).select(*statements(F.col("s"), is_type.alias("typed")))
    # a blank node with a type is an entity too, and reached from itself
    marks = quads.where(is_type & (is_ref | blank("s"))).select("graph", F.col("s").alias("subject"), "p", "pos", "o", F.lit(None).cast("string").alias("kind"), F.lit(True).alias("typed"))
    itself = quads.where(is_type & blank("s")).select("graph", F.col("s").alias("subject"), F.col("s").alias("of")).distinct()
    refs = quads.where(is_ref).select("graph", F.col("s").alias("subject"), F.col("o").alias("of"))
    inner = refs.where(blank("subject")).select(F.col("graph").alias("in_graph"), F.col("subject").alias("node"), F.col("of").alias("next"))
    paths = [refs] if depth > 0 else []
    if depth > 1 and not inner.isEmpty():
        inner = saved(inner, "inner")
        for _ in range(depth - 1):
            last = paths[-1]
            paths.append(saved(last.join(inner, (F.col("graph") == F.col("in_graph")) & (F.col("of") == F.col("node"))).select("graph", "subject", F.col("next").alias("of")), "paths"))
            if paths[-1].isEmpty():
                break
    held = quads.where(~is_ref & blank("s")).select(F.col("graph").alias("in_graph"), F.col("s").alias("node"), "p", "pos", "o", "o_kind")
    # a join by sorting, as rows made from small files are more than Spark can tell beforehand
    below = reduce(DataFrame.unionByName, [itself, *paths]).join(held.hint("merge"), F.col("graph").eqNullSafe(F.col("in_graph")) & (F.col("of") == F.col("node")))
    return own.unionByName(marks).unionByName(below.select(*statements(F.col("subject"), F.lit(False).alias("typed"))))


def entity_properties(quads: DataFrame, depth: int = MAX_DEPTH) -> DataFrame:
    """(graph, subject, p, o, o_kind, pos): all statements of each entity but those that hold a blank node, with those of blank nodes it holds."""
    typed = quads.where(F.col("p") == RDF_TYPE).select(F.col("graph").alias("in_graph"), F.col("s").alias("of")).distinct()
    x = entity_statements(quads, depth).where(F.col("kind").isNotNull())
    kept = x.join(typed, F.col("graph").eqNullSafe(F.col("in_graph")) & F.col("subject").eqNullSafe(F.col("of")), "left_semi")
    return kept.select("graph", "subject", "p", "o", F.col("kind").alias("o_kind"), "pos")


def entities(quads: DataFrame, depth: int = MAX_DEPTH) -> DataFrame:
    """(url, context, props): one row per entity; of several values of a property the last in the input wins."""
    # dealt before it is aggregated: what lies together beforehand is few, and the sort for it would spill
    dealt = entity_statements(quads, depth).repartition("graph", "subject")
    last = F.max(F.when(F.col("kind").isNotNull(), F.struct("pos", "o")))
    values = dealt.groupBy("graph", "subject", "p").agg(last.alias("last"), F.max("typed").alias("typed"))
    whole = values.groupBy("graph", "subject").agg(F.collect_list(F.when(F.col("last").isNotNull(), F.struct("p", "last.o"))).alias("props"), F.max("typed").alias("typed"))
    kept = whole.where(F.col("typed") & (F.size("props") > 0))
    return kept.select(F.col("subject").alias("url"), F.col("graph").alias("context"), F.map_from_entries(F.sort_array("props")).alias("props"))


def entity_table(ents: DataFrame, trigger: str, columns: list[str], required: str) -> DataFrame:
    """One row per entity of class `trigger` whose property `required` is not blank; missing values are empty."""
    p = lambda c: F.coalesce(F.try_element_at("props", F.lit(c)), F.lit(""))
    rows = ents.where((F.try_element_at("props", F.lit(RDF_TYPE)) == trigger) & (F.trim(p(required)) != ""))
    return rows.select("url", *(p(c).alias(c.rpartition("#")[2].rpartition("/")[2]) for c in columns))


def class_counts(ents: DataFrame) -> DataFrame:
    return ents.groupBy(F.try_element_at("props", F.lit(RDF_TYPE)).alias("class")).agg(F.count("*").alias("entities"), F.countDistinct(domain(F.col("context"))).alias("domains"))


def _exploded(ents: DataFrame) -> DataFrame:
    return ents.select("url", "context", F.try_element_at("props", F.lit(RDF_TYPE)).alias("class"), F.explode("props").alias("p", "o"))


def property_counts(ents: DataFrame) -> DataFrame:
    """(p, n) without rdf:type."""
    return _exploded(ents).where(F.col("p") != RDF_TYPE).groupBy("p").agg(F.count("*").alias("n"))


def property_histogram(ents: DataFrame, of_class: str) -> DataFrame:
    """(p, n) of one class, with rdf:type."""
    return _exploded(ents).where(F.col("class") == of_class).groupBy("p").agg(F.count("*").alias("n"))


def totals(ents: DataFrame) -> DataFrame:
    """Entities, properties (rdf:type included), domains, links (values that begin with http), remote links, literals; one row."""
    values, link = F.map_values("props"), lambda x: x.startswith("http")
    n = lambda test: F.coalesce(F.sum(F.size(F.filter(values, test)).cast("long")), F.lit(0))
    # one aggregation, as entities are made anew for each
    return ents.agg(
        F.count("*").alias("entities"),
        F.countDistinct(domain(F.col("context"))).alias("domains"),
        F.coalesce(F.sum(F.size("props").cast("long")), F.lit(0)).alias("properties"),
        n(link).alias("links"),
        n(lambda x: link(x) & (domain(x) != domain(F.col("context")))).alias("remote_links"),
        n(lambda x: ~link(x)).alias("literals"),
    )


def domain_runs(quads: DataFrame) -> DataFrame:
    """How often the domain changes in input order, as one row; a check on how clustered the input is.

    Changes are counted inside ranges of pos, in parallel; each range also tells its first and last
    domain, and only those meet.
    """
    # written, as dealing by ranges reads its input twice
    d = saved(quads.select("pos", domain(F.col("graph")).alias("domain")), "domains")
    part = F.spark_partition_id()
    ranged = d.repartitionByRange("pos").withColumn("part", part)
    inside = ranged.selectExpr("part", "pos", "domain", "case when domain <> lag(domain) over (partition by part order by pos) then 1 else 0 end as changed")
    ends = inside.groupBy("part").agg(F.min_by("domain", "pos").alias("first"), F.max_by("domain", "pos").alias("last"), F.sum("changed").alias("changes"))
    return ends.selectExpr("changes + case when first <> lag(last) over (order by part) then 1 else 0 end as n").agg((F.coalesce(F.sum("n"), F.lit(0)) + F.when(F.count("*") > 0, 1).otherwise(0)).alias("runs"))


# Queries: orders are entities, lineitems blank nodes below them.

_B = "http://data.example.org/"


def _order_quads(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    x = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    s = lambda k: F.concat(F.lit(f"{_B}o/"), F.col(k).cast("string"))
    graph = lambda k: F.concat(F.lit("http://g"), (F.col(k) % 29).cast("string"), F.lit(".example.org/"))
    quad = lambda subj, p, obj, kind, pos, g: F.struct(subj.alias("s"), F.lit(p).alias("p"), obj.cast("string").alias("o"), F.lit(kind).alias("o_kind"), pos.alias("pos"), g.alias("graph"))
    node = F.concat(F.lit("_:l"), F.col("l_orderkey").cast("string"), F.lit("x"), F.col("l_linenumber").cast("string"))
    at = F.col("o_orderkey") * 1000
    top = o.select(
        F.explode(
            F.array(
                quad(s("o_orderkey"), RDF_TYPE, F.when(F.col("o_orderkey") % 3 == 0, f"{_B}Big").otherwise(f"{_B}Order"), "iri", at, graph("o_orderkey")),
                quad(s("o_orderkey"), f"{_B}status", F.col("o_orderstatus"), "literal", at + 1, graph("o_orderkey")),
                quad(s("o_orderkey"), f"{_B}customer", F.concat(F.lit("http://g1.example.org/c/"), F.col("o_custkey").cast("string")), "iri", at + 2, graph("o_orderkey")),
            )
        ).alias("q")
    )
    line = F.col("l_orderkey") * 1000 + F.col("l_linenumber") * 10
    below = x.select(
        F.explode(
            F.array(
                quad(s("l_orderkey"), f"{_B}item", node, "bnode", line, graph("l_orderkey")),
                quad(node, f"{_B}quantity", F.col("l_quantity").cast("int"), "literal", line + 1, graph("l_orderkey")),
                quad(node, f"{_B}flag", F.col("l_returnflag"), "literal", line + 2, graph("l_orderkey")),
            )
        ).alias("q")
    )
    return top.unionByName(below).select("q.*")


def entity_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = entities(_order_quads(spark, sf_dir))
    p = lambda c: F.try_element_at("props", F.lit(c))
    return e.select("url", "context", p(RDF_TYPE).alias("class"), p(f"{_B}status").alias("status"), p(f"{_B}quantity").alias("quantity"), p(f"{_B}flag").alias("flag"), F.size("props").cast("long").alias("n"))


def entity_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_counts(entities(_order_quads(spark, sf_dir)))


def entity_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals(entities(_order_quads(spark, sf_dir)))


def entity_property_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return property_histogram(entities(_order_quads(spark, sf_dir)), f"{_B}Big")


def entity_domain_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domain_runs(_order_quads(spark, sf_dir))


def hcard_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    s, at = F.concat(F.lit(f"{_B}c/"), F.col("c_custkey").cast("string")), F.col("c_custkey") * 10
    quad = lambda p, obj, kind, pos: F.struct(s.alias("s"), F.lit(p).alias("p"), obj.cast("string").alias("o"), F.lit(kind).alias("o_kind"), pos.alias("pos"), F.lit("http://g.example.org/").alias("graph"))
    rows = F.array(
        quad(RDF_TYPE, F.lit(f"{VCARD}VCard"), "iri", at),
        quad(f"{VCARD}fn", F.when(F.col("c_custkey") % 9 == 0, " ").otherwise(F.col("c_name")), "literal", at + 1),
        quad(f"{VCARD}title", F.col("c_mktsegment"), "literal", at + 2),
        quad(f"{VCARD}title", F.lower("c_mktsegment"), "literal", at + 3),
    )
    quads = c.select(F.explode(rows).alias("q")).select("q.*")
    t = entity_table(entities(quads), f"{VCARD}VCard", [f"{VCARD}{x}" for x in ("fn", "title", "role")], f"{VCARD}fn")
    return t.select("url", "fn", "title", "role")


QUERIES = {f.__name__: f for f in (entity_assembly, entity_class_counts, entity_totals, entity_property_histogram, entity_domain_runs, hcard_table)}
_LAST = "(select l_orderkey, max(l_linenumber) as ln from lineitem group by 1)"
_ENT = f"""e as (select o_orderkey, '{_B}o/' || o_orderkey as url, 'http://g' || (o_orderkey % 29) || '.example.org/' as context,
        case when o_orderkey % 3 = 0 then '{_B}Big' else '{_B}Order' end as class, o_orderstatus as status, o_custkey,
        l.l_quantity as quantity, l.l_returnflag as flag
        from orders o left join {_LAST} m on m.l_orderkey = o.o_orderkey left join (select l_orderkey, l_linenumber, max(l_quantity::int::varchar) as l_quantity, max(l_returnflag) as l_returnflag from lineitem group by 1, 2) l on l.l_orderkey = m.l_orderkey and l.l_linenumber = m.ln)"""
ORACLE_SQL = {
    "entity_assembly": f"with {_ENT} select url, context, class, status, quantity, flag, (3 + case when quantity is null then 0 else 2 end)::bigint as n from e",
    "entity_class_counts": f"with {_ENT} select class, count(*) as entities, count(distinct context) as domains from e group by 1",
    "entity_totals": f"""with {_ENT} select count(*) as entities, count(distinct context) as domains, sum(3 + case when quantity is null then 0 else 2 end)::bigint as properties,
        2 * count(*) as links, (count(*) + count_if(o_orderkey % 29 <> 1))::bigint as remote_links, sum(1 + case when quantity is null then 0 else 2 end)::bigint as literals from e""",
    "entity_property_histogram": f"""with {_ENT}, b as (select * from e where class = '{_B}Big') select p, n from (
        select '{RDF_TYPE}' as p, count(*) as n from b union all select '{_B}status', count(*) from b union all select '{_B}customer', count(*) from b
        union all select '{_B}quantity', count(quantity) from b union all select '{_B}flag', count(flag) from b) where n > 0""",
    "hcard_table": f"select '{_B}c/' || c_custkey as url, c_name as fn, lower(c_mktsegment) as title, '' as role from customer where c_custkey % 9 <> 0",
    "entity_domain_runs": """with q as (select o_orderkey * 1000 as pos, o_orderkey % 29 as d from orders union all select l_orderkey * 1000 + l_linenumber * 10, l_orderkey % 29 from lineitem)
        select count(*) as runs from (select d, lag(d) over (order by pos, d) as b from q) where b is null or b <> d""",
}
