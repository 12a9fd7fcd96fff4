"""Web tables as relations (arrays of columns): filters, schemas, dedup, keys, headers, types, and lookups by URL or label."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from loomcrawl.functions.text import has_time_expression, terms
from loomcrawl.functions.typing import cell_pattern, cell_type, column_types

DATASET_SCHEMA = (
    "relation array<array<string>>, pageTitle string, title string, url string, hasHeader boolean, headerPosition string, tableType string, tableNum int, s3Link string, "
    "recordEndOffset long, recordOffset long, tableOrientation string, textBeforeTable string, textAfterTable string, hasKeyColumn boolean, keyColumnIndex int, headerRowIndex int"
)
MIN_KEY_RANK, MIN_KEY_LENGTH, MAX_KEY_LENGTH, MAX_RANKED_LENGTH = 0.5, 3.5, 200, 50
SAMPLED_ROWS, SHORT_CELL = 5, 10
#: Rows of terms that cross to the JVM at once.
_TERM_ROWS = 100_000


def read_datasets(lines: DataFrame) -> DataFrame:
    """Tables from JSON lines (column value), `key TAB json` or json alone; a row that is no table has a null dataset."""
    body = F.when(F.col("value").startswith("{"), F.col("value")).otherwise(F.regexp_extract("value", r"^[^\t]*\t(.*)$", 1))
    parsed = F.from_json(body, DATASET_SCHEMA)
    return lines.select("value", F.when(parsed["relation"].isNotNull(), parsed).alias("dataset"))


def write_datasets(tables: DataFrame, path: str) -> None:
    """JSON lines, gzip."""
    tables.write.option("compression", "gzip").json(path)


def headers(relation: Column) -> Column:
    """Names of the columns, without commas, lower case."""
    return F.transform(relation, lambda c: F.lower(F.replace(F.coalesce(F.try_element_at(c, F.lit(1)), F.lit("")), F.lit(","), F.lit(""))))


def schema_text(relation: Column) -> Column:
    return F.concat_ws(",", headers(relation))


def wide(tables: DataFrame, columns: int = 8) -> DataFrame:
    return tables.where(F.size("relation") > columns)


def of_top_domains(tables: DataFrame, url: str = "url", endings: tuple[str, ...] = (".com", ".net", ".org", ".uk")) -> DataFrame:
    """Tables with a header whose URL holds one of the endings."""
    return tables.where(F.col("hasHeader") & F.greatest(*(F.col(url).contains(e) for e in endings)))


def dedup_tables(tables: DataFrame, order: str, relation: str = "relation") -> DataFrame:
    """Of tables with equal headers and equal first two data rows, the first by `order`.

    One aggregate keeps a whole row per group, combined before the shuffle: copies of a frequent table
    do not meet in a task.
    """
    column = F.col(relation)
    sample = F.transform(column, lambda c: F.concat_ws("\x1f", F.slice(c, 2, 2)))
    key = F.sha2(F.concat_ws("\x1e", F.transform(column, lambda c: F.coalesce(F.try_element_at(c, F.lit(1)), F.lit(""))), F.lit("\x1d"), sample), 256)
    whole = tables.select(F.struct("*").alias("t"), F.col(order).alias("o"), key.alias("k"))
    return whole.groupBy("k").agg(F.min_by("t", "o").alias("t")).select("t.*")


def transposed(grid: Column) -> Column:
    """Rows of an array of equally long columns."""
    return F.transform(F.sequence(F.lit(1), F.size(F.element_at(grid, 1))), lambda i: F.transform(grid, lambda c: F.try_element_at(c, i)))


def _count(cells: Column, pattern: str) -> Column:
    return F.aggregate(cells, F.lit(0), lambda a, x: a + F.length(F.regexp_replace(F.trim(x), pattern, "")))


def is_alphanumeric(cells: Column) -> Column:
    """Over half of the signs are letters or spaces, and other signs than these and digits are under a tenth of them."""
    letters, digits = _count(cells, r"[^\p{IsAlphabetic}\p{Z}]"), _count(cells, r"\P{Nd}")
    other = _count(cells, r"[\p{IsAlphabetic}\p{Z}\p{Nd}]")
    return (letters + digits + other > 0) & (letters * 2 > letters + digits + other) & (other * 10 < letters)


def average_length(cells: Column) -> Column:
    return F.try_divide(F.aggregate(cells, F.lit(0), lambda a, x: a + F.length(x)), F.size(cells))


def key_rank(cells: Column) -> Column:
    """Share of distinct values less share of empty ones; 0 for columns of long cells."""
    empty = F.size(F.filter(cells, lambda x: x == ""))
    return F.when(average_length(cells) > MAX_RANKED_LENGTH, 0.0).otherwise(F.try_divide(F.size(F.array_distinct(cells)) - empty, F.size(cells)))


def key_column(relation: Column) -> Column:
    """Index from 0 of the key column, or -1: the first of the best ranked among alphanumeric columns of fair length, if ranked 0.5 or more."""
    ranked = F.transform(relation, lambda c, i: F.struct(key_rank(c).alias("rank"), (-i).alias("i"), (is_alphanumeric(c) & (average_length(c) > MIN_KEY_LENGTH) & (average_length(c) <= MAX_KEY_LENGTH)).alias("ok")))
    best = F.try_element_at(F.sort_array(F.filter(ranked, lambda r: r["ok"]), asc=False), F.lit(1))
    return F.coalesce(F.when(best["rank"] >= MIN_KEY_RANK, -best["i"]), F.lit(-1))


def header_row(relation: Column) -> Column:
    """0 if the first row looks like a header, else -1, by the patterns of cells in the first five rows.

    No header if all first-row cells but one at most are short and have the pattern of the cell below;
    otherwise a header, unless patterns change too often from row to row below it. Rows are read up to
    an e-mail address.
    """
    patterns = F.transform(relation, lambda c: F.transform(F.slice(c, 1, SAMPLED_ROWS), lambda x: cell_pattern(F.coalesce(x, F.lit("")))))
    width, rows = F.size(relation), F.size(F.element_at(patterns, 1))
    short = F.size(F.filter(F.arrays_zip(relation.alias("c"), patterns.alias("p")), lambda z: (F.length(F.element_at(z["c"], 1)) <= SHORT_CELL) & (F.try_element_at(z["p"], F.lit(1)) == F.try_element_at(z["p"], F.lit(2)))))

    def changes(i: Column) -> Column:
        row = F.transform(relation, lambda c: F.element_at(c, i))
        mail = F.array_position(F.transform(row, lambda x: x.rlike(r"^.+@.+\..+$")), True)
        seen = F.when(mail > 0, F.slice(patterns, F.lit(1), mail.cast("int") - 1)).otherwise(patterns)
        return F.size(F.filter(seen, lambda p: F.element_at(p, i) != F.element_at(p, i + 1)))

    flags = F.when(rows > 2, F.aggregate(F.sequence(F.lit(2), F.greatest(rows - 1, F.lit(2))), F.lit(0), lambda a, i: a + changes(i))).otherwise(0)
    return F.when(rows < 2, -1).when(short >= width - 1, -1).when(flags > 2 * rows, -1).otherwise(0)


def label_lookup(rows: DataFrame, labels: DataFrame, on: str) -> DataFrame:
    """Rows with a label, and the label's columns. Spark sends labels to all executors where they are few."""
    return rows.join(labels, on)


def most_frequent(n: int):
    """A function of arrays of terms: their n most frequent ones as (term, tf), ties by term; nothing for null."""

    @F.arrow_udf(ArrayType(StructType([StructField("term", StringType()), StructField("tf", LongType())])))
    def runs(ordered: pa.Array) -> pa.Array:
        size, flat = np.asarray(ordered.value_lengths().fill_null(0)), ordered.flatten()
        row = np.repeat(np.arange(len(ordered)), size)
        code = flat.dictionary_encode().indices.to_numpy() if len(flat) else np.empty(0, np.int64)
        starts = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (code[1:] != code[:-1])))) if len(flat) else np.empty(0, np.int64)
        tf, of = np.diff(np.append(starts, len(flat))), row[starts]
        order = np.lexsort((np.arange(len(tf)), -tf, of))  # runs come by term
        order = order[np.arange(len(order)) - np.searchsorted(of, of) < n]
        kept = np.bincount(of[order], minlength=len(ordered))
        pairs = pa.StructArray.from_arrays([flat.take(pa.array(starts[order])), pa.array(tf[order], pa.int64())], ["term", "tf"])
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(kept))), pa.int32()), pairs)

    return lambda found: runs(F.array_sort(found))


def top_terms(docs: DataFrame, doc_id: str, text: str, n: int = 100) -> DataFrame:
    """(doc_id, term, tf): the n most frequent terms of each row, ties by term. Terms are counted inside their row; nothing is shuffled."""
    return docs.select(doc_id, F.explode(most_frequent(n)(terms(F.col(text)))).alias("t")).select(doc_id, "t.term", "t.tf")


def text_index(tables: DataFrame, doc_id: str, fields: dict[str, Column]) -> DataFrame:
    """An inverted index: (field, term, doc_id, tf)."""
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), terms(c).alias("terms")) for f, c in fields.items()))
    x = tables.select(doc_id, F.explode(pairs).alias("x")).select(doc_id, "x.field", F.explode("x.terms").alias("term"))
    return x.groupBy("field", "term", doc_id).agg(F.count("*").alias("tf"))


def row_terms(tables: DataFrame, doc_id: str, fields: dict[str, Column]) -> DataFrame:
    """(field, term, doc_id, tf) as text_index has them, but counted inside each row, so that nothing is shuffled: a document of several rows has several."""
    names = list(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, field in enumerate(names, 1):
                found = b.column(k)
                words = found.flatten().dictionary_encode()
                if not len(words):
                    continue
                row = np.repeat(np.arange(len(found)), np.asarray(found.value_lengths().fill_null(0)))
                key, tf = np.unique(row * len(words.dictionary) + words.indices.to_numpy(), return_counts=True)
                row, code = np.divmod(key, len(words.dictionary))
                for at in range(0, len(key), _TERM_ROWS):
                    part = slice(at, at + _TERM_ROWS)
                    term = words.dictionary.take(pa.array(code[part]))
                    yield pa.RecordBatch.from_arrays([pa.array([field]).take(pa.array(np.zeros(len(term), np.int64))), term, b.column(0).take(pa.array(row[part])), pa.array(tf[part], pa.int64())], ["field", "term", doc_id, "tf"])

    schema = StructType([StructField("field", StringType()), StructField("term", StringType()), tables.select(doc_id).schema[0], StructField("tf", LongType())])
    return tables.select(doc_id, *(terms(c).alias(f"terms_{k}") for k, c in enumerate(fields.values()))).mapInArrow(run, schema)


# Queries


def _relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of parts by brand and size: name, brand, type, size and price; with exact copies, and copies that differ after row 2."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    cells = F.struct("p_partkey", "p_name", "p_brand", "p_type", F.col("p_size").cast("string").alias("p_size"))
    t = p.groupBy("p_brand", (F.col("p_size") % 5).alias("part")).agg(F.array_sort(F.collect_list(cells)).alias("rows"))
    column = lambda c: F.concat(F.array(F.lit(c)), F.transform("rows", lambda r: r[c]))
    t = t.select(F.concat_ws("-", "p_brand", "part").alias("id"), F.array(*map(column, ("p_name", "p_brand", "p_type", "p_size"))).alias("relation"))
    cut = F.transform("relation", lambda c: F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(3))))
    return t.unionByName(t.withColumn("id", F.concat("id", F.lit("-copy")))).unionByName(t.select(F.concat("id", F.lit("-late")).alias("id"), cut.alias("relation")))


def table_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_tables(_relations(spark, sf_dir), "id").select("id")


def table_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of which every second part has two columns, every other third part three."""
    t = _relations(spark, sf_dir)
    part = F.split_part("id", F.lit("-"), F.lit(2)).cast("int")
    t = t.withColumn("relation", F.slice("relation", F.lit(1), F.when(part % 2 == 1, 2).when(part % 3 == 0, 3).otherwise(4)))
    return t.groupBy(schema_text(F.col("relation")).alias("schema")).agg(F.count("*").alias("tables"), F.sum(F.size(F.element_at("relation", 1)) - 1).alias("rows"))


def key_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables whose id holds -0 are without their names, so that both outcomes occur."""
    t = _relations(spark, sf_dir).withColumn("relation", F.transform("relation", lambda c: F.slice(c, F.lit(2), F.size(c))))
    t = t.withColumn("relation", F.when(F.col("id").contains("-0"), F.slice("relation", F.lit(2), F.lit(2))).otherwise(F.col("relation")))
    return t.groupBy(key_column(F.col("relation")).alias("key_column")).agg(F.count("*").alias("tables"))


def header_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _relations(spark, sf_dir)
    body = t.select("id", F.transform("relation", lambda c: F.slice(c, F.lit(2), F.size(c))).alias("relation"))
    narrow = body.select("id", F.slice("relation", F.lit(2), F.lit(1)).alias("relation"))
    return t.unionByName(body).unionByName(narrow).groupBy(header_row(F.col("relation")).alias("header_row")).agg(F.count("*").alias("tables"))


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    k, col = F.col("p_partkey"), F.pmod(F.floor(F.col("p_partkey") / 7), F.lit(60))
    price = F.format_string("%d.%02d", (k * 37) % 1000, k % 100)
    kinds = [F.lit(""), F.col("p_size").cast("string"), F.concat(F.lit("$"), price), price, F.col("p_name"), F.concat((k * 1000003).cast("string"), F.lit("00"))]
    pick = F.when(col % 4 == 0, 1).when(col % 4 == 1, F.pmod(k, F.lit(2)) + 2).when(col % 4 == 2, F.pmod(k, F.lit(3)) + 3).otherwise(F.pmod(k, F.lit(10)))
    cell = F.lit("x y")
    for i, c in enumerate(kinds):
        cell = F.when(pick == i, c).otherwise(cell)
    return p.select(k.alias("k"), col.alias("col"), cell.alias("cell"))


def cell_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(spark, sf_dir).groupBy(cell_type(F.col("cell")).alias("type")).agg(F.count("*").alias("n"))


def column_typing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_types(_cells(spark, sf_dir), ["col"], "cell")


def cell_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(spark, sf_dir).groupBy(cell_pattern(F.col("cell")).alias("pattern")).agg(F.count("*").alias("n"))


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, x = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return label_lookup(d.select("doc_id", "lang", "source"), x, "doc_id")


def time_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("text"))
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    made = F.element_at(F.array(F.date_format("o_orderdate", "dd-MM-yyyy"), F.concat(F.lit("at "), F.date_format("o_orderdate", "HH:mm")), F.lit("nothing here"), F.concat(F.lit("in "), F.date_format("o_orderdate", "yyyy"), F.lit(" BC")), F.lit("5 o'clock")), (F.col("o_orderkey") % 5 + 1).cast("int"))
    x = d.unionByName(o.select(made.alias("text")))
    return x.groupBy(has_time_expression(F.col("text")).alias("has_time")).agg(F.count("*").alias("n"))


def term_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_terms(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text", 10)


def inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    return text_index(p, "p_partkey", {"name": F.regexp_replace("p_name", r"[^A-Za-z0-9]+", " "), "brand": F.regexp_replace("p_brand", r"[^A-Za-z0-9]+", " ")})


QUERIES = {f.__name__: f for f in (table_dedup, table_schemas, key_columns, header_rows, cell_types, column_typing, cell_patterns, labelled_documents, time_expressions, term_topn, inverted_index)}
_REL = """g as (select p_brand || '-' || (p_size % 5) as id, list(p_partkey order by p_partkey) as k, list(p_name order by p_partkey) as a, list(p_brand order by p_partkey) as b, list(p_type order by p_partkey) as c, list(p_size::varchar order by p_partkey) as d from part group by 1),
    r as (select id, a, b, c, d from g union all select id || '-copy', a, b, c, d from g
          union all select id || '-late', a[1:greatest(len(a) - 1, 2)], b[1:greatest(len(b) - 1, 2)], c[1:greatest(len(c) - 1, 2)], d[1:greatest(len(d) - 1, 2)] from g)"""
_CELLS = r"""c as (select p_partkey as k, (p_partkey // 7) % 60 as col, printf('%d.%02d', (p_partkey * 37) % 1000, p_partkey % 100) as price, p_size, p_name from part),
    d as (select *, case when col % 4 = 0 then 1 when col % 4 = 1 then k % 2 + 2 when col % 4 = 2 then k % 3 + 3 else k % 10 end as pick from c),
    cells as (select k, col, case pick when 0 then '' when 1 then p_size::varchar when 2 then '$' || price when 3 then price when 4 then p_name when 5 then (k * 1000003) || '00' else 'x y' end as cell from d),
    t as (select *, case when cell = '' then 'none'
        when len(regexp_extract(cell, '-?\s*([$£₤]\s*[\d,]+(\.\d+)?)|([\d,]+(\.\d+)?\s*[€])')) / len(cell) > 0.6 then 'currency'
        when len(regexp_extract(cell, '-?[\d,]+\.\d+(\s)?(%)?')) / len(cell) > 0.6 then 'double'
        when len(regexp_extract(cell, '(^|[^\d])-?[\d,]{1,9}(\s)?(%)?($|[^\d])')) / len(cell) > 0.6 then 'integer'
        when len(regexp_extract(cell, '-?[\d,]+')) / len(cell) > 0.6 then 'long' else 'string' end as type from cells)"""
_TERMS = r"""x as (select doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+(?:[''.][\p{L}\p{N}]+)*')) as t from documents),
    w as (select doc_id, strip_accents(replace(replace(replace(case when ends_with(t, '''s') then t[:-3] else t end, 'ß', 'ss'), 'æ', 'ae'), 'œ', 'oe')) as term from x)"""
_STOP = "('a','an','and','are','as','at','be','but','by','for','if','in','into','is','it','no','not','of','on','or','such','that','the','their','then','there','these','they','this','to','was','will','with')"
def _pattern(cell: str) -> str:
    for run, to in (("[a-zA-Z]+", "a"), ("[0-9]+", "d"), (r"""[^ad\s.!;():?,\-''"]+""", "s"), (r"""[\s.!;():?,\-''"]+""", "p")):
        cell = f"regexp_replace({cell}, '{run}', '{to}', 'g')"
    return cell


# what each kind of expression looks like, one by one
_TIME = " or ".join(
    f"regexp_matches(text, '{p}')"
    for p in (
        r"([0-2]?[0-9]|3[0-9])[.-]([0-2]?[0-9]|3[0-9])[.-]([0-9]{2}|[0-9]{4})([,.\s]|$)",
        r"([Jj]an(uary)?|[Ff]eb(ruary)?|[Mm]ar(ch)?|[Aa]pr(il)?|May|[Jj]une?|[Jj]uly?|[Aa]ug(ust)?|[Ss]ep(tember)?|[Oo]ct(ober)?|[Nn]ov(ember)?|[Dd]ec(ember)?)([,.\s]|$)",
        r"([0-9]|[01][0-9]|2[0-3]):([0-9]|[0-5][0-9])(:([0-9]|[0-5][0-9]))?(\s?(AM|PM|h|H))?([,.\s]|$)",
        r"[12][0-9][0-9][0-9]([-,./\s]|$)",
        r"[0-9]\s?(BC|AC|B\.C\.|A\.C\.)([-,./\s]|$)",
        r"([0-9]|1[0-9]|2[0-4])\s?[oO][''`][cC]lock([,.\s]|$)",
    )
)
ORACLE_SQL = {
    "time_expressions": f"""with x as (select text from documents union all select case o_orderkey % 5 when 0 then strftime(o_orderdate, '%d-%m-%Y') when 1 then 'at ' || strftime(o_orderdate, '%H:%M')
            when 2 then 'nothing here' when 3 then 'in ' || strftime(o_orderdate, '%Y') || ' BC' else '5 o''clock' end from orders)
        select coalesce({_TIME}, false) as has_time, count(*) as n from x group by 1""",
    "key_columns": rf"""with {_REL},
        t as (select id, 0 as i, a as col from r where id not like '%-0%' union all select id, 1, b from r where id not like '%-0%' union all select id, 2, c from r where id not like '%-0%'
              union all select id, 3, d from r where id not like '%-0%' union all select id, 0, b from r where id like '%-0%' union all select id, 1, c from r where id like '%-0%'),
        x as (select id, i, len(col) as n, len(list_distinct(col)) as u, list_sum(list_transform(col, lambda v: len(v))) / len(col) as l, array_to_string(col, '') as s from t),
        y as (select *, len(regexp_replace(s, '[^\p{{L}}\p{{Z}}]', '', 'g')) as letters, len(regexp_replace(s, '\P{{Nd}}', '', 'g')) as digits, len(s) as signs from x),
        z as (select id, i, case when l > 50 then 0.0 else u / n end as rank from y where 2 * letters > signs and 10 * (signs - letters - digits) < letters and l > 3.5 and l <= 200),
        best as (select id, arg_min(i, (-rank, i)) as i, max(rank) as rank from z group by 1)
        select coalesce(case when rank >= 0.5 then best.i else -1 end, -1)::int as key_column, count(*) as tables from r left join best on best.id = r.id group by 1""",
    "table_dedup": f"with {_REL} select min(id) as id from r group by a[1:2], b[1:2], c[1:2], d[1:2]",
    "table_schemas": f"""with {_REL}, w as (select *, split_part(id, '-', 2)::int as part from r)
        select array_to_string(['p_name', 'p_brand', 'p_type', 'p_size'][1:case when part % 2 = 1 then 2 when part % 3 = 0 then 3 else 4 end], ',') as schema, count(*) as tables, sum(len(a))::bigint as rows from w group by 1""",
    "header_rows": f"""with {_REL},
        u as (select [list_prepend('p_name', a), list_prepend('p_brand', b), list_prepend('p_type', c), list_prepend('p_size', d)] as t from r union all select [a, b, c, d] from r union all select [b] from r),
        n as (select row_number() over () as k, list_transform(t, lambda c: c[1:5]) as t from u),
        c as (select k, i, j, t[j][i] as cell, t[j][i + 1] as next, len(t) as width, len(t[1]) as height from n, range(1, 6) g(i), range(1, 5) h(j) where j <= len(t) and i <= len(t[1])),
        z as (select *, {_pattern('cell')} as p, {_pattern('next')} as q from c),
        f as (select k, any_value(width) as width, any_value(height) as height, count(*) filter (i = 1 and next is not null and len(cell) <= 10 and p = q) as short,
              count(*) filter (i > 1 and next is not null and p <> q) as flags from z group by k)
        select (case when height < 2 or short >= width - 1 or flags > 2 * height then -1 else 0 end)::int as header_row, count(*) as tables from f group by 1""",
    "cell_types": f"with {_CELLS} select type, count(*) as n from t group by 1",
    "column_typing": f"""with {_CELLS}, n as (select col, type, count(*) as n, sum(count(*)) over (partition by col) as length,
            case type when 'none' then -1 when 'string' then 0 when 'double' then 4 when 'long' then 6 when 'integer' then 7 else 8 end as s from t group by 1, 2),
        v as (select *, row_number() over (partition by col order by n desc, s) as place, count(*) over (partition by col) as kinds from n where type <> 'none'),
        x as (select col, any_value(kinds) as kinds, any_value(length) as length, max(n) filter (place = 1) as n1, max(n) filter (place = 2) as n2, max(type) filter (place = 1) as t1,
              sum(n) filter (s >= 4) as numbers, min_by(type, s) filter (s >= 4) as least from v group by 1)
        select c.col, case when x.kinds is null then 'none' when kinds = 1 then t1 when (n1 - n2) / length > 0.4 then t1 when coalesce(numbers, 0) / length > 0.9 then least else 'string' end as type
        from (select distinct col from cells) c left join x on x.col = c.col""",
    "cell_patterns": rf"""with {_CELLS} select regexp_replace(regexp_replace(regexp_replace(regexp_replace(cell, '[a-zA-Z]+', 'a', 'g'), '[0-9]+', 'd', 'g'), '[^ad\s.!;():?,\-''"]+', 's', 'g'), '[\s.!;():?,\-''"]+', 'p', 'g') as pattern, count(*) as n from cells group by 1""",
    "labelled_documents": "select doc_id, lang, source, quality, toxic from documents join labels using (doc_id)",
    "term_topn": f"""with {_TERMS}, n as (select doc_id, term, count(*) as tf from w where term <> '' and term not in {_STOP} group by 1, 2)
        select doc_id, term, tf from (select *, row_number() over (partition by doc_id order by tf desc, term) as place from n) where place <= 10""",
    "inverted_index": f"""with x as (select 'name' as field, p_partkey, unnest(str_split(lower(regexp_replace(p_name, '[^A-Za-z0-9]+', ' ', 'g')), ' ')) as term from part
            union all select 'brand', p_partkey, unnest(str_split(lower(regexp_replace(p_brand, '[^A-Za-z0-9]+', ' ', 'g')), ' ')) from part)
        select field, term, p_partkey, count(*) as tf from x where term <> '' and term not in {_STOP} group by 1, 2, 3""",
}
