"""Longest-match lookups in rule tables as joins: namespaces of IRIs, public suffixes of hosts.

Each distinct value gives its cut points as rows, these meet the rules in an equi-join, and an aggregation by value keeps
the rule that wins. Tables of rules are DataFrames of any size: Spark sends them to all executors where they are
small, and joins by key beyond that. Values are looked up once however often they occur; the join back to the rows
has one partner a row, so that a frequent value can be split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcrawl.functions.urls import host


def _looked_up(rows: DataFrame, value: str, found: DataFrame, default: Column, out: str) -> DataFrame:
    """rows with `out`: what found (_of, _found) has for the value, else the default. No column of rows is in the way."""
    held = rows.select(F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("_row"))
    joined = held.join(found, F.col("_row").getField(value) == F.col("_of"), "left")
    kept = [F.col("_row").getField(c).alias(c) for c in rows.columns if c != out]
    return joined.select(*kept, F.coalesce(F.col("_found"), default).alias(out))


def longest_namespace(iris: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(_of, prefix, n): of each IRI (_of) the longest namespace that it begins with, n its length.

    prefixes: (prefix, namespace); rows with a null or an empty namespace are no rules, and of several
    prefixes of a namespace the first by code point counts. An IRI is cut only where some namespace ends: at their
    lengths, a number that their longest one bounds, and after one of their last characters.
    """
    rules = prefixes.where("prefix is not null and namespace <> ''").groupBy("namespace").agg(F.min("prefix").alias("prefix"))
    ends = rules.groupBy(F.length("namespace").alias("n")).agg(F.array_sort(F.collect_set(F.right("namespace", F.lit(1)))).alias("last")).orderBy("n").collect()
    cuts = F.array(*(F.struct(F.lit(r["n"]).alias("n"), F.array(*map(F.lit, r["last"])).alias("last")) for r in ends)) if ends else F.array().cast("array<struct<n:int,last:array<string>>>")
    fits = F.filter(cuts, lambda c: (c["n"] <= F.length("_of")) & F.array_contains(c["last"], F.substring(F.col("_of"), c["n"], F.lit(1))))
    parts = iris.select("_of", F.explode(F.transform(fits, lambda c: F.left(F.col("_of"), c["n"]))).alias("namespace"))
    return parts.join(rules, "namespace").groupBy("_of").agg(F.max(F.struct(F.length("namespace").alias("n"), "prefix")).alias("best")).select("_of", "best.prefix", "best.n")


def abbreviate(rows: DataFrame, iri: str, prefixes: DataFrame, out: str = "short") -> DataFrame:
    """rows with `out`: prefix:rest by the longest namespace that the IRI begins with, the IRI itself without one, null for null."""
    iris = rows.select(F.col(f"`{iri}`").alias("_of")).where("_of is not null").distinct()
    short = F.concat(F.col("prefix"), F.lit(":"), F.substring(F.col("_of"), F.col("n") + 1, F.length("_of")))
    return _looked_up(rows, iri, longest_namespace(iris, prefixes).select("_of", short.alias("_found")), F.col("_row").getField(iri), out)


def registered_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(_of, _found): of each host (_of) the public suffix and the label before it.

    rules: (rule) as public suffix lists write them: `com`, `co.uk`, `*.ck` (any one label before the rest), `!www.ck` (an
    exception: its parent is the suffix). An exception wins, then the rule of most labels; without a rule the last label is
    the suffix. A host that is a suffix itself, an IP address and a null have no row. Blank rules are none; rules are
    compared in lower case.
    """
    r = rules.select(F.lower(F.trim("rule")).alias("rule")).where("rule <> '' and not rule like '//%'")
    kind = F.when(F.col("rule").startswith("!"), "!").when(F.col("rule").startswith("*."), "*").otherwise("")
    rules = r.select(kind.alias("kind"), F.regexp_replace("rule", r"^(!|\*\.)", "").alias("key")).distinct()
    labels = F.split("_of", r"\.")
    size = F.size(labels)
    tail = lambda n: F.array_join(F.slice(labels, size - n + 1, n), ".")
    # n: labels that a rule matches; a wildcard is found by the labels after its own
    cuts = F.transform(F.sequence(F.lit(1), size), lambda n: F.struct(tail(n).alias("key"), n.alias("n")))
    named = hosts.where(F.col("_of").isNotNull() & ~F.col("_of").rlike(r"^[0-9.]+$|^\[|^\.|\.\.|^$"))
    cut = named.select("_of", F.explode(cuts).alias("c")).select("_of", "c.key", "c.n")
    met = cut.join(rules, "key").select("_of", (F.col("kind") == "!").alias("exception"), (F.col("n") + (F.col("kind") == "*").cast("int")).alias("n")).where(F.col("n") <= size)
    best = met.groupBy("_of").agg(F.max(F.struct("exception", "n")).alias("best"))
    take = F.when(F.col("best").isNull(), 2).when(F.col("best.exception"), F.col("best.n")).otherwise(F.col("best.n") + 1)
    found = named.join(best.withColumnRenamed("_of", "_host"), F.col("_of") == F.col("_host"), "left").withColumn("take", take)
    return found.where(F.col("take") <= size).select("_of", tail(F.col("take")).alias("_found"))


def registered_domains(rows: DataFrame, url: str, rules: DataFrame, out: str = "registered_domain") -> DataFrame:
    """rows with `out`: the registered domain of an http(s) URL's host by the rules, null where there is none."""
    known = F.regexp_replace(host(F.col(f"`{url}`")), r"\.$", "")
    hosts = rows.select(F.col(f"`{url}`").alias("_url"), known.alias("_of")).distinct()
    found = registered_hosts(hosts.select("_of").distinct(), rules)
    by_url = hosts.join(found.withColumnRenamed("_of", "_host"), F.col("_of") == F.col("_host")).select(F.col("_url").alias("_of"), "_found")
    return _looked_up(rows, url, by_url, F.lit(None).cast("string"), out)


# Queries

_BASE = "http://data.example.org/"
#: As many namespaces as the vocabularies in use; every third one is nested in the one before it, twice.
NAMESPACES = 2943


def _namespaces(spark: SparkSession) -> DataFrame:
    i, of = F.col("id"), (F.col("id") / 3).cast("long").cast("string")
    below = F.element_at(F.array(F.lit(""), F.lit("terms/"), F.lit("terms/x#")), (i % 3 + 1).cast("int"))
    return spark.range(NAMESPACES).select(F.concat(F.lit("p"), i.cast("string")).alias("prefix"), F.concat(F.lit(f"{_BASE}v"), of, F.lit("/"), below).alias("namespace"))


def iri_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    k = F.col("o_orderkey")
    rest = F.element_at(F.array(F.lit("name"), F.lit("terms/name"), F.lit("terms/x#name"), F.lit("terms/x"), F.lit("terms"), F.lit("")), (k % 6 + 1).cast("int"))
    iri = F.when(k % 97 == 0, F.concat(F.lit("urn:order:"), k.cast("string"))).otherwise(F.concat(F.lit(f"{_BASE}v"), (F.col("o_custkey") % 1200).cast("string"), F.lit("/"), rest))
    return abbreviate(o.select("o_orderkey", iri.alias("iri")), "iri", _namespaces(spark))


#: Rules of all three kinds, some of them nested.
RULES = ("com", "co.uk", "uk", "*.ck", "!www.ck", "*.kawasaki.jp", "!city.kawasaki.jp", "jp", "nom.br", "br", "*.nom.br")


def _hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    one = F.element_at(F.array(*map(F.lit, ("a.example.com", "Example.COM", "com", "x.y.co.uk", "co.uk", "b.uk", "a.b.foo.ck", "foo.ck", "www.ck", "m.www.ck", "s.city.kawasaki.jp", "t.u.other.kawasaki.jp", "kawasaki.jp", "n.nom.br", "m.n.nom.br", "q.w.unknown", "unknown", "10.1.2.3"))), (k % 18 + 1).cast("int"))
    url = F.when(k % 19 == 0, F.concat(F.lit("ftp://"), one)).otherwise(F.concat(F.lit("https://u@"), one, F.lit(":8080/p?k="), k.cast("string")))
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", url.alias("url"))


def registered_domain_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame([(r,) for r in RULES], "rule string")
    return registered_domains(_hosts(spark, sf_dir), "url", rules).select("c_custkey", "registered_domain")


QUERIES = {f.__name__: f for f in (iri_prefixes, registered_domain_rules)}
ORACLE_SQL = {
    "iri_prefixes": f"""with t as (select 'p' || i as prefix, '{_BASE}v' || (i // 3) || '/' || ['', 'terms/', 'terms/x#'][i % 3 + 1] as namespace from range({NAMESPACES}) r(i)),
        x as (select o_orderkey, case when o_orderkey % 97 = 0 then 'urn:order:' || o_orderkey
            else '{_BASE}v' || (o_custkey % 1200) || '/' || ['name', 'terms/name', 'terms/x#name', 'terms/x', 'terms', ''][o_orderkey % 6 + 1] end as iri from orders),
        d as (select distinct iri from x),
        b as (select iri, arg_max(prefix || ':' || substr(iri, length(namespace) + 1), length(namespace)) as short from d join t on starts_with(iri, namespace) group by iri)
        select o_orderkey, x.iri, coalesce(short, x.iri) as short from x left join b using (iri)""",
    # rule by rule, from the meaning of each
    "registered_domain_rules": r"""with h as (select c_custkey, case when c_custkey % 19 = 0 then null else lower(['a.example.com', 'Example.COM', 'com', 'x.y.co.uk', 'co.uk', 'b.uk', 'a.b.foo.ck', 'foo.ck', 'www.ck', 'm.www.ck', 's.city.kawasaki.jp', 't.u.other.kawasaki.jp', 'kawasaki.jp', 'n.nom.br', 'm.n.nom.br', 'q.w.unknown', 'unknown', '10.1.2.3'][c_custkey % 18 + 1]) end as h from customer)
        select c_custkey, nullif(case
            when h ~ '^[0-9.]+$' then ''
            when h ~ '(^|\.)www\.ck$' then 'www.ck'
            when h ~ '(^|\.)city\.kawasaki\.jp$' then 'city.kawasaki.jp'
            when h ~ '\.ck$' then regexp_extract(h, '[^.]+\.[^.]+\.ck$')
            when h ~ '\.kawasaki\.jp$' then regexp_extract(h, '[^.]+\.[^.]+\.kawasaki\.jp$')
            when h ~ '\.nom\.br$' then regexp_extract(h, '[^.]+\.[^.]+\.nom\.br$')
            when h ~ '(^|\.)co\.uk$' then regexp_extract(h, '[^.]+\.co\.uk$')
            else regexp_extract(h, '[^.]+\.[^.]+$') end, '') as registered_domain from h""",
}
