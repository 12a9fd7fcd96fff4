"""Relational tables in pages: cells from HTML, filters with reasons, header, orientation, features and classes.

Only the reading of HTML runs in Python, one page at a time; it gives one row per table with its cells,
and everything after that is column expressions and aggregates over cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcrawl.functions.html_dom import Node, parse
from loomcrawl.functions.text import has_time_expression, terms
from loomcrawl.operators.relations import header_row, key_column, most_frequent, transposed
from loomcrawl.operators.scratch import saved

CELL = "struct<tag:string,text:string,forms:int,links:int,images:int,inputs:int,selects:int,heads:int>"
TABLE = f"url string, table_no int, page_title string, title string, in_form boolean, has_table boolean, has_span boolean, widths array<int>, grid array<array<{CELL}>>, before string, after string, paragraphs_before array<string>, paragraphs_after array<string>"
# Fixed values of the filters.
MIN_ROWS, MIN_COLUMNS, MAX_EMPTY, MAX_LINKS, CONTEXT_WORDS, SAMPLE = 3, 2, 0.49, 0.51, 250, 10
# The features of the two phases, in the order of the models' attributes.
PHASE_1 = (
    "LOCAL_RATIO_IS_NUMBER_COL_1 LOCAL_RATIO_ANCHOR_ROW_1 RATIO_IMG LOCAL_RATIO_ANCHOR_COL_1 LOCAL_LENGTH_VARIANCE_COL_1 LOCAL_RATIO_IMAGE_COL_1 LOCAL_RATIO_IMAGE_COL_0 LOCAL_SPAN_RATIO_COL_2 LOCAL_SPAN_RATIO_COL_1 "
    "LOCAL_AVG_LENGTH_ROW_2 LOCAL_RATIO_HEADER_ROW_0 RATIO_DIGIT LOCAL_RATIO_IMAGE_ROW_0 RATIO_ALPHABETICAL LOCAL_RATIO_IMAGE_ROW_1 LOCAL_RATIO_INPUT_COL_1 LOCAL_RATIO_INPUT_COL_0 LOCAL_RATIO_CONTAINS_NUMBER_ROW_2 "
    "LOCAL_AVG_LENGTH_COL_0 RATIO_EMPTY AVG_ROWS LOCAL_RATIO_INPUT_ROW_1 LOCAL_RATIO_CONTAINS_NUMBER_COL_2 LOCAL_RATIO_HEADER_COL_1 LOCAL_RATIO_INPUT_ROW_0 AVG_COLS"
).split()
PHASE_2 = (
    "LOCAL_RATIO_IS_NUMBER_COL_0 AVG_CELL_LENGTH LOCAL_RATIO_IS_NUMBER_COL_2 LOCAL_RATIO_COLON_ROW_1 LOCAL_RATIO_ANCHOR_ROW_2 LOCAL_LENGTH_VARIANCE_COL_2 LOCAL_AVG_LENGTH_ROW_0 LOCAL_AVG_LENGTH_ROW_2 "
    "LOCAL_RATIO_HEADER_ROW_0 CUMULATIVE_CONTENT_CONSISTENCY STD_DEV_ROWS RATIO_ALPHABETICAL LOCAL_RATIO_COMMA_COL_0 LOCAL_RATIO_CONTAINS_NUMBER_ROW_1 LOCAL_RATIO_CONTAINS_NUMBER_ROW_0 STD_DEV_COLS "
    "LOCAL_RATIO_COLON_COL_0 MAX_COLS LOCAL_RATIO_CONTAINS_NUMBER_COL_2 LOCAL_RATIO_HEADER_COL_1 LOCAL_RATIO_HEADER_COL_2 LOCAL_RATIO_CONTAINS_NUMBER_COL_0 AVG_COLS"
).split()
CONTENT_TYPES = ("FORM", "HYPERLINK", "IMAGE", "ALPHABETICAL", "DIGIT", "EMPTY", "OTHERS")  # by priority


def _rows(table: Node) -> list[list[Node]]:
    """Cells by row, of the table itself and its sections, without those of tables inside."""
    rows = []
    for part in table.children:
        if isinstance(part, Node):
            for r in [part] if part.tag == "tr" else [c for c in part.children if isinstance(c, Node) and c.tag == "tr"] if part.tag in ("thead", "tbody", "tfoot") else []:
                rows.append([c for c in r.children if isinstance(c, Node) and c.tag in ("td", "th")])
    return rows


def _span(cell: Node, name: str) -> int:
    value = cell.attrs.get(name, "1").strip()
    return int(value) if value.isdigit() and 0 < int(value) < 1000 else -1


def _grid(rows: list[list[Node]]) -> list[list[Node | None]] | None:
    """Cells by place; None where a span covers a place. No grid if a span is no number, overlaps or leaves the table."""
    width = max((sum(max(1, _span(c, "colspan")) for c in r) for r in rows), default=0)
    taken: dict[tuple[int, int], Node | None] = {}
    for i, r in enumerate(rows):
        j = 0
        for c in r:
            while (i, j) in taken:
                j += 1
            down, right = _span(c, "rowspan"), _span(c, "colspan")
            if down < 0 or right < 0 or i + down > len(rows):
                return None
            for y in range(i, i + down):
                for x in range(j, j + right):
                    if (y, x) in taken:
                        return None
                    taken[y, x] = c if (y, x) == (i, j) else None
            j += right
            width = max(width, j)
    return [[taken.get((i, j)) for j in range(width)] for i in range(len(rows))]


def _cell(c: Node | None) -> dict | None:
    if c is None:
        return None
    n = lambda *tags: len(c.find(*tags)) + (c.tag in tags)
    return {"tag": c.tag, "text": c.text(), "forms": n("form"), "links": n("a"), "images": n("img"), "inputs": n("input"), "selects": n("select"), "heads": n("th")}


def page_tables(html: str, url: str) -> list[dict]:
    """The tables of one page, in document order, as rows of TABLE."""
    root = parse(html)
    tables = root.find("table")
    if not tables:
        return []
    heads = root.find("title")
    body = (root.find("body") or [root])[0]
    order: dict[int, int] = {id(n): k for k, n in enumerate(body.walk())}
    paragraphs = [(order.get(id(p), -1), p.text()) for p in body.find("p")]
    out = []
    for no, t in enumerate(tables):
        rows = [r for r in _rows(t)]
        inside = {id(t), *(id(n) for n in t.walk())}
        words: tuple[list[str], list[str]] = ([], [])
        stack: list = list(reversed(body.children))
        after = 0
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                words[after].extend(x.split())
            elif x is t:
                after = 1
            elif x.tag not in ("script", "style"):
                stack.extend(reversed(x.children))
        captions = [c for c in t.find("caption")]
        at = order.get(id(t), 0)
        grid = _grid(rows)
        out.append(
            {
                "url": url, "table_no": no, "page_title": heads[0].text() if heads else None, "title": captions[0].text() if len(captions) == 1 else None,
                "in_form": any(a.tag == "form" for a in t.ancestors()), "has_table": bool(t.find("table")), "has_span": any("colspan" in c.attrs or "rowspan" in c.attrs for r in rows for c in r),
                "widths": [len(r) for r in rows], "grid": None if grid is None else [[_cell(c) for c in r] for r in grid],
                "before": " ".join(words[0][-CONTEXT_WORDS:]), "after": " ".join(words[1][:CONTEXT_WORDS]),
                "paragraphs_before": [p for k, p in paragraphs if 0 <= k < at], "paragraphs_after": [p for k, p in paragraphs if k > at + len(inside) - 1],
            }
        )
    return out


def extract_tables(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """One row per table of each page, as TABLE; pages without `<table` do not reach Python."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 100):
                part = b.slice(k, 100)
                rows = [t for h, u in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) for t in page_tables(h, u)]
                yield pa.RecordBatch.from_pylist(rows, arrow)

    arrow = to_arrow_schema(_parse_datatype_string(TABLE))
    return pages.where(F.col(html).rlike("(?i)<table")).select(F.col(html).alias("html"), F.col(url).alias("url")).mapInArrow(run, TABLE)


def _cells() -> Column:
    return F.flatten("grid")


def reject_reason(lenient: bool = False) -> Column:
    """Why a table is no relation candidate, or null. lenient: only form, nesting, no grid and less than 2 x 2."""
    rows, widths = F.size("widths"), F.col("widths")
    modal = F.aggregate(F.array_distinct(widths), F.struct(F.lit(0).alias("n"), F.lit(0).alias("w")), lambda a, w: F.greatest(a, F.struct(F.size(F.filter(widths, lambda x: x == w)).alias("n"), w.alias("w"))))["w"]
    area = F.size(_cells())
    empty = F.size(F.filter(_cells(), lambda c: c.isNull() | (c["text"] == "") & (c["images"] == 0)))
    links = F.size(F.filter(_cells(), lambda c: c["links"] > 0))
    first = F.when(F.col("in_form"), "in_form").when(F.col("has_table"), "nested")
    if lenient:
        return first.when(F.col("grid").isNull(), "bad_spans").when((rows < 2) | (F.array_max(widths) < 2), "small")
    return (
        first.when(rows < MIN_ROWS, "few_rows")
        .when(modal < MIN_COLUMNS, "few_columns")
        .when(F.col("has_span") | F.col("grid").isNull(), "spans")
        .when(F.array_max(widths) != modal, "ragged")
        .when(empty > F.floor(area * MAX_EMPTY), "sparse")
        .when(links > F.floor(area * MAX_LINKS), "link_list")
    )


def header_position() -> Column:
    """FIRST_ROW if all cells of the first row but its first are th, FIRST_COLUMN if the first cells of all rows but the first are; MIXED, NONE."""
    row = F.forall(F.slice(F.element_at("grid", 1), F.lit(2), F.size(F.element_at("grid", 1))), lambda c: F.coalesce(c["tag"] == "th", F.lit(False)))
    column = F.forall(F.slice("grid", F.lit(2), F.size("grid")), lambda r: F.coalesce(F.element_at(r, 1)["tag"] == "th", F.lit(False)))
    return F.when(row & column, "MIXED").when(row, "FIRST_ROW").when(column, "FIRST_COLUMN").otherwise("NONE")


def _mean_deviation(lines: Column) -> Column:
    """Mean over lines of the sample standard deviation of the lengths of their cells."""
    mean = lambda x: F.aggregate(x, F.lit(0.0), lambda a, v: a + v) / F.size(x)
    dev = F.transform(lines, lambda x: F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, v: a + F.pow(v - mean(x), F.lit(2))) / F.greatest(F.size(x) - 1, F.lit(1))))
    return mean(dev)


def orientation(header: Column, kind: Column | None = None) -> Column:
    """VERTICAL or HORIZONTAL by the header; MIXED for a matrix; else by how much lengths vary along rows and columns of the first 10 x 10 cells."""
    lengths = F.transform(F.slice("grid", 1, SAMPLE), lambda r: F.transform(F.slice(r, 1, SAMPLE), lambda c: F.length(F.coalesce(c["text"], F.lit(""))).cast("double")))
    by_column, by_row = _mean_deviation(transposed(lengths)), _mean_deviation(lengths)
    out = F.when(header == "FIRST_COLUMN", "VERTICAL").when(header == "FIRST_ROW", "HORIZONTAL")
    if kind is not None:
        out = out.when(kind == "MATRIX", "MIXED")
    return out.when(by_column <= by_row, "HORIZONTAL").otherwise("VERTICAL")


def relations(tables: DataFrame) -> DataFrame:
    """Kept tables with header position, orientation, relation (columns; vertical tables turned), header row and key column."""
    t = tables.withColumn("reject_reason", reject_reason()).where("reject_reason is null").withColumn("header_position", header_position())
    t = t.withColumn("orientation", orientation(F.col("header_position")))
    texts = F.transform("grid", lambda r: F.transform(r, lambda c: F.coalesce(c["text"], F.lit(""))))
    t = t.withColumn("relation", F.when(F.col("orientation") == "VERTICAL", texts).otherwise(transposed(texts)))
    has_th = F.exists(_cells(), lambda c: c["tag"] == "th")
    t = t.withColumn("header_row", F.when(has_th, F.when(F.col("header_position") == "NONE", -1).otherwise(0)).otherwise(header_row(F.col("relation"))))
    body = F.transform("relation", lambda c: F.when(F.col("header_row") == 0, F.slice(c, F.lit(2), F.size(c))).otherwise(c))
    timed = lambda c: F.filter(c, lambda p: has_time_expression(p))
    return t.withColumn("key_column", key_column(body)).withColumn("time_before", timed("paragraphs_before")).withColumn("time_after", timed("paragraphs_after"))


def body_text(html: Column) -> Column:
    """The text of a page's body, or of the whole page without one: no scripts, styles, comments and tags."""
    body = F.regexp_extract(html, r"(?is)<body\b[^>]*>(.*)", 1)
    return F.regexp_replace(F.when(body == "", html).otherwise(body), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|</body\s*>.*|<[^>]*>", " ")


def lenient_relations(pages: DataFrame, html: str = "html", url: str = "url", n_terms: int = 100) -> DataFrame:
    """(url, table_no, page_title, title, has_header, header_position, relation, term_set): all tables that are in no form, hold no other and have 2 x 2 cells.

    relation has columns, as they stand; term_set the page's n_terms most frequent terms, by term. Pages that share a url share
    the terms of one of them.
    """
    t = extract_tables(pages, html, url).where(reject_reason(True).isNull()).withColumn("header_position", header_position())
    texts = F.transform("grid", lambda r: F.transform(r, lambda c: F.coalesce(c["text"], F.lit(""))))
    kept = t.select("url", "table_no", "page_title", "title", F.exists(_cells(), lambda c: F.coalesce(c["tag"] == "th", F.lit(False))).alias("has_header"), "header_position", transposed(texts).alias("relation"))
    found = most_frequent(n_terms)(terms(body_text(F.col(html))))
    words = pages.where(F.col(html).rlike("(?i)<table")).select(F.col(url).alias("of"), F.array_sort(F.transform(found, lambda x: x["term"])).alias("term_set"))
    return kept.join(words.groupBy("of").agg(F.min("term_set").alias("term_set")), F.col("url") == F.col("of"), "left").drop("of")


def content_type(cell: Column) -> Column:
    signs = F.regexp_replace(cell["text"], r"\s+", "")
    letters, digits = F.length(F.regexp_replace(signs, r"[^\p{IsAlphabetic}]", "")), F.length(F.regexp_replace(signs, r"\P{Nd}", ""))
    return (
        F.when(cell["forms"] > 0, "FORM").when(cell["links"] > 0, "HYPERLINK").when(cell["images"] > 0, "IMAGE")
        .when(signs == "", "EMPTY").when(letters + digits == 0, "OTHERS").when(digits > letters, "DIGIT").otherwise("ALPHABETICAL")
    )


def features(tables: DataFrame, key: list[str]) -> DataFrame:
    """key and the features of both phases as doubles, one row per table with a grid of 2 x 2 at least.

    Grids are written once, so that HTML is parsed once, and dealt by key once: cells are rows of their table's
    partition, where whole-table features are one aggregate, those of the first, second and last rows and columns
    another, by line, and all of them are joined.
    """
    grids = saved(tables.where("grid is not null and size(grid) >= 2 and size(grid[0]) >= 2").select(*key, "grid"), "grids").repartition(*key)
    t = grids.select(*key, F.size("grid").alias("h"), F.size(F.col("grid")[0]).alias("w"), F.posexplode("grid").alias("r", "cells"))
    x = t.select(*key, "h", "w", "r", F.posexplode("cells").alias("c", "cell")).withColumn("kind", content_type(F.col("cell"))).withColumn("is", F.col("cell").isNotNull())
    of = lambda cond: F.count_if(F.col("is") & cond)
    cells = F.count_if("is")
    ratio = lambda cond: F.coalesce(of(cond) / F.when(cells > 0, cells), F.lit(0.0))
    text = F.col("cell.text")
    length = F.when(F.col("is"), F.length(text))
    whole = x.groupBy(*key).agg(
        (cells / F.first("w")).alias("AVG_ROWS"), (cells / F.first("h")).alias("AVG_COLS"), F.coalesce(F.avg(length), F.lit(0.0)).alias("AVG_CELL_LENGTH"),
        *(ratio(F.col("kind") == k).alias(n) for k, n in (("IMAGE", "RATIO_IMG"), ("ALPHABETICAL", "RATIO_ALPHABETICAL"), ("DIGIT", "RATIO_DIGIT"), ("EMPTY", "RATIO_EMPTY"))),
    )

    def lines(axis: str, other: str) -> DataFrame:
        """Per line: its cells, and how many agree with the line's dominant type less those that do not."""
        n = x.where("is").groupBy(*key, axis, "kind").agg(F.count("*").alias("n"))
        return n.groupBy(*key, axis).agg(F.sum("n").alias("cells"), F.max("n").alias("most")).withColumn("agree", 2 * F.col("most") - F.col("cells"))

    shape = grids.select(*key, F.size("grid").alias("h"), F.size(F.col("grid")[0]).alias("w"))
    deviation = lambda n: F.sqrt(F.greatest(F.sum(F.col("cells") * F.col("cells")) / n - F.pow(F.sum("cells") / n, F.lit(2)), F.lit(0.0)))
    rows = lines("r", "c").join(shape, key).groupBy(*key).agg(F.max("cells").cast("double").alias("MAX_COLS"), deviation(F.first("h")).alias("STD_DEV_COLS"), (F.sum("agree") / F.first("h")).alias("agree_r"))
    cols = lines("c", "r").join(shape, key).groupBy(*key).agg(deviation(F.first("w")).alias("STD_DEV_ROWS"), (F.sum("agree") / F.first("w")).alias("agree_c"))
    ends = F.array(
        *(F.when(F.col(a) == at, n) for a, size, n0 in (("r", "h", "ROW"), ("c", "w", "COL")) for at, n in ((F.lit(0), f"{n0}_0"), (F.lit(1), f"{n0}_1"), (F.col(size) - 1, f"{n0}_2")))
    )
    by_line = x.withColumn("line", F.explode(F.filter(ends, lambda n: n.isNotNull())))
    number = F.expr("try_cast(cell.text as double)").isNotNull()
    local = {
        "LOCAL_AVG_LENGTH": F.coalesce(F.avg(length), F.lit(0.0)), "LOCAL_LENGTH_VARIANCE": F.coalesce(F.var_pop(length), F.lit(0.0)), "LOCAL_SPAN_RATIO": F.count_if(~F.col("is")) / F.count("*"),
        "LOCAL_RATIO_HEADER": ratio(F.col("cell.heads") > 0), "LOCAL_RATIO_ANCHOR": ratio(F.col("cell.links") > 0), "LOCAL_RATIO_IMAGE": ratio(F.col("cell.images") > 0), "LOCAL_RATIO_INPUT": ratio(F.col("cell.inputs") > 0), "LOCAL_RATIO_SELECT": ratio(F.col("cell.selects") > 0),
        "LOCAL_RATIO_COLON": ratio(text.endswith(":")), "LOCAL_RATIO_COMMA": ratio(text.contains(",")), "LOCAL_RATIO_CONTAINS_NUMBER": ratio(text.rlike(r"\d")), "LOCAL_RATIO_IS_NUMBER": ratio(number),
    }
    per_line = by_line.groupBy(*key, "line").agg(*(v.alias(k) for k, v in local.items()))
    wanted = [n for n in dict.fromkeys(PHASE_1 + PHASE_2) if n.startswith("LOCAL_")]
    pivot = per_line.groupBy(*key).agg(*(F.max(F.when(F.col("line") == n[-5:], F.col(n[:-6]))).alias(n) for n in wanted))
    joined = reduce(lambda a, b: a.join(b, key), [whole, rows, cols, pivot])
    joined = joined.withColumn("CUMULATIVE_CONTENT_CONSISTENCY", F.greatest("agree_r", "agree_c"))
    return joined.select(*key, *dict.fromkeys(PHASE_1 + PHASE_2))


def train_classifiers(labelled: DataFrame, label: str = "table_type"):
    """Two forests from features and labels LAYOUT, RELATION, ENTITY, MATRIX, OTHER: layout against the rest, then the kinds of the rest."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    def forest(names: list[str], of: str) -> Pipeline:
        return Pipeline(stages=[VectorAssembler(inputCols=names, outputCol=f"{of}_x"), StringIndexer(inputCol=of, outputCol=f"{of}_y"), RandomForestClassifier(featuresCol=f"{of}_x", labelCol=f"{of}_y", predictionCol=f"{of}_p", probabilityCol=f"{of}_prob", rawPredictionCol=f"{of}_raw", numTrees=20, seed=1)])

    first = labelled.withColumn("phase1", F.when(F.col(label) == "LAYOUT", "LAYOUT").otherwise("REST"))
    second = labelled.where(F.col(label) != "LAYOUT").withColumn("phase2", F.col(label))
    return forest(PHASE_1, "phase1").fit(first), forest(PHASE_2, "phase2").fit(second)


def classify(feats: DataFrame, models) -> DataFrame:
    """feats with table_type, and the probabilities of both phases."""
    from pyspark.ml.functions import vector_to_array

    first, second = models
    name = lambda m, p: F.element_at(F.array(*map(F.lit, m.stages[1].labels)), (F.col(p) + 1).cast("int"))
    x = _scored(feats, first, second)
    kind = F.when(name(first, "phase1_p") == "LAYOUT", "LAYOUT").otherwise(name(second, "phase2_p"))
    return x.select(*feats.columns, kind.alias("table_type"), vector_to_array("phase1_prob").alias("phase1_probability"), vector_to_array("phase2_prob").alias("phase2_probability"))


def _scored(feats: DataFrame, first, second) -> DataFrame:
    x = feats
    for m in (first, second):
        for k in (0, 2):  # the assembler and the forest; the label's indexer is for training
            x = m.stages[k].transform(x)
    return x


def rejection_counters(tables: DataFrame) -> DataFrame:
    """(counter, n) over all tables; kept ones count as such."""
    return tables.groupBy(F.coalesce(reject_reason(), F.lit("kept")).alias("counter")).agg(F.count("*").alias("n"))


# Queries: HTML tables of customers by nation, some broken in a way that a filter tells.


def _table_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per nation and sixth of its customers. Number k of a nation, by k % 6: a good table; with th; in a form; two rows; with a colspan; all cells links."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").withColumn("k", (F.floor(F.col("c_custkey") / 3) % 6).cast("int"))
    link = lambda v: F.when(F.col("k") == 5, F.concat(F.lit("<a href='/x'>"), v, F.lit("</a>"))).otherwise(v)
    span = F.when((F.col("k") == 4), "<td colspan=2>").otherwise("<td>")
    row = F.concat(F.lit("<tr>"), span, link(F.col("c_name")), F.lit("</td><td>"), link(F.col("c_mktsegment")), F.lit("</td><td>"), link(F.floor("c_acctbal").cast("string")), F.lit("</td></tr>"))
    g = c.groupBy("c_nationkey", "k").agg(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", row.alias("row")))), lambda x: x["row"]).alias("rows"))
    rows = F.when(F.col("k") == 3, F.slice("rows", 1, 2)).otherwise(F.col("rows"))
    head = F.when(F.col("k") == 1, "<tr><td></td><th>segment</th><th>balance</th></tr>").otherwise("")
    table = F.concat(F.lit("<table>"), head, F.array_join(rows, ""), F.lit("</table>"))
    body = F.when(F.col("k") == 2, F.concat(F.lit("<form>"), table, F.lit("</form>"))).otherwise(table)
    page = F.concat(F.lit("<html><head><title>T</title></head><body><p>On 12-05-2010 it was so.</p>"), body, F.lit("<p>no date</p></body></html>"))
    return g.select(F.concat_ws("/", F.lit("http://t.example.org"), "c_nationkey", "k").alias("url"), page.alias("html"))


def table_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejection_counters(extract_tables(_table_pages(spark, sf_dir)))


def table_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = relations(extract_tables(_table_pages(spark, sf_dir)))
    return r.select("url", "header_position", "orientation", "page_title", "before", "after", F.size(F.col("relation")[0]).alias("rows"), F.size("time_before").alias("dated_before"), F.size("time_after").alias("dated_after"))


def lenient_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = lenient_relations(_table_pages(spark, sf_dir))
    shape = F.size("relation").alias("columns"), F.size(F.col("relation")[0]).alias("rows")
    return r.select("url", *shape, "has_header", "header_position", F.element_at(F.col("relation")[0], -1).alias("last"), F.array_join("term_set", " ").alias("terms"))


def table_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = features(extract_tables(_table_pages(spark, sf_dir)), ["url"])
    return f.select("url", *(F.round(c, 6).alias(c.lower()) for c in dict.fromkeys(PHASE_1 + PHASE_2)))


QUERIES = {f.__name__: f for f in (table_filters, table_relations, lenient_tables, table_features)}
def _features_sql() -> str:
    """Cells of the queries' pages, made from the customers, and all features from these."""
    local = {
        "LOCAL_AVG_LENGTH": "coalesce(avg(len(txt)), 0)", "LOCAL_LENGTH_VARIANCE": "coalesce(var_pop(len(txt)), 0)", "LOCAL_SPAN_RATIO": "count(*) filter (txt is null) / count(*)",
        "LOCAL_RATIO_HEADER": "head", "LOCAL_RATIO_ANCHOR": "link", "LOCAL_RATIO_IMAGE": "false", "LOCAL_RATIO_INPUT": "false", "LOCAL_RATIO_SELECT": "false",
        "LOCAL_RATIO_COLON": "ends_with(txt, ':')", "LOCAL_RATIO_COMMA": "contains(txt, ',')", "LOCAL_RATIO_CONTAINS_NUMBER": "txt ~ '.*[0-9].*'", "LOCAL_RATIO_IS_NUMBER": "try_cast(txt as double) is not null",
    }
    line = {"ROW_0": "r = 0", "ROW_1": "r = 1", "ROW_2": "r = h - 1", "COL_0": "c = 0", "COL_1": "c = 1", "COL_2": "c = w - 1"}

    def one(name: str) -> str:
        what, where = local[name[:-6]], line[name[-5:]]
        if "(" in what and not what.startswith(("ends", "contains", "try")):
            return what.replace("avg(len(txt))", f"avg(len(txt)) filter ({where})").replace("var_pop(len(txt))", f"var_pop(len(txt)) filter ({where})").replace("filter (txt is null)", f"filter (txt is null and {where})").replace("/ count(*)", f"/ count(*) filter ({where})")
        return f"coalesce(count(*) filter (txt is not null and ({what}) and {where}) / nullif(count(*) filter (txt is not null and {where}), 0), 0)"

    whole = {
        "AVG_ROWS": "count(txt) / any_value(w)", "AVG_COLS": "count(txt) / any_value(h)", "AVG_CELL_LENGTH": "avg(len(txt))", "RATIO_IMG": "0",
        "RATIO_ALPHABETICAL": "count(*) filter (kind = 'letters') / count(txt)", "RATIO_DIGIT": "count(*) filter (kind = 'digits') / count(txt)", "RATIO_EMPTY": "count(*) filter (kind = 'empty') / count(txt)",
        "MAX_COLS": "any_value(max_cols)", "STD_DEV_COLS": "any_value(dev_cols)", "STD_DEV_ROWS": "any_value(dev_rows)", "CUMULATIVE_CONTENT_CONSISTENCY": "greatest(any_value(agree_r), any_value(agree_c))",
    }
    shown = ", ".join(f"round(({whole[n] if n in whole else one(n)})::double, 6) as {n.lower()}" for n in dict.fromkeys(PHASE_1 + PHASE_2))
    lines = lambda axis, size: f"""
        n{axis} as (select url, {axis}, kind, count(*) as n from x where txt is not null group by all),
        l{axis} as (select url, {axis}, sum(n) as cells, 2 * max(n) - sum(n) as agree from n{axis} group by all),
        t{axis} as (select url, max(cells) as most, sqrt(greatest(sum(cells * cells) / any_value({size}) - (sum(cells) / any_value({size})) ** 2, 0)) as dev, sum(agree) / any_value({size}) as agree from l{axis} join s using (url) group by url)"""  # noqa: E731
    return rf"""
        with o as (select *, (c_custkey // 3) % 6 as k, row_number() over (partition by c_nationkey, (c_custkey // 3) % 6 order by c_custkey) as place from customer),
        b as (select 'http://t.example.org/' || c_nationkey || '/' || k as url, k, place - (k <> 1)::int as r, unnest([c_name, c_mktsegment, floor(c_acctbal)::bigint::varchar]) as txt, unnest(case when k = 4 then [0, 2, 3] else [0, 1, 2] end) as c, k = 5 as link, false as head from o where k <> 3 or place <= 2
              union all select distinct 'http://t.example.org/' || c_nationkey || '/1', 1, 0, unnest(['', 'segment', 'balance']), unnest([0, 1, 2]), false, unnest([false, true, true]) from o where k = 1),
        s as (select url, max(r) + 1 as h, any_value(case when k = 4 then 4 else 3 end) as w from b group by url having max(r) >= 1),
        a as (select b.* from b union all select url, 4, r, null, 1, false, false from b where k = 4 and c = 0),
        x as (select a.*, h, w, case when txt is null then null when link then 'link' when trim(txt) = '' then 'empty' when len(regexp_replace(txt, '[^0-9]', '', 'g')) > len(regexp_replace(txt, '[^\p{{L}}]', '', 'g')) then 'digits'
              when txt ~ '.*[\p{{L}}0-9].*' then 'letters' else 'others' end as kind from a join s using (url)),{lines('r', 'h')},{lines('c', 'w')}
        select x.url, {shown} from (select x.*, tr.most as max_cols, tr.dev as dev_cols, tc.dev as dev_rows, tr.agree as agree_r, tc.agree as agree_c from x join tr using (url) join tc using (url)) x group by x.url"""


_G = "g as (select c_nationkey, (c_custkey // 3) % 6 as k, count(*) as n from customer group by 1, 2)"
ORACLE_SQL = {
    "table_filters": f"""with {_G} select case when k = 2 then 'in_form' when least(n, case when k = 3 then 2 else n end) + (k = 1)::int < 3 then 'few_rows' when k = 4 then 'spans' when k = 5 then 'link_list' else 'kept' end as counter, count(*) as n
        from g group by 1""",
    "table_relations": """
        with o as (select *, (c_custkey // 3) % 6 as k, row_number() over (partition by c_nationkey, (c_custkey // 3) % 6 order by c_custkey) as place from customer),
        c as (select c_nationkey as n, k, place - (k <> 1)::int as r, unnest([len(c_name), len(c_mktsegment), len(floor(c_acctbal)::bigint::varchar)]) as l, unnest([0, 1, 2]) as c from o where k < 2
              union all select distinct c_nationkey, 1, 0, unnest([0, 7, 7]), unnest([0, 1, 2]) from o where k = 1),
        h as (select n, k, max(r) + 1 as rows from c group by all having max(r) >= 2),
        x as (select n, k, avg(d) as by_column from (select n, k, c, coalesce(stddev_samp(l), 0) as d from c where r < 10 group by all) group by all),
        y as (select n, k, avg(d) as by_row from (select n, k, r, coalesce(stddev_samp(l), 0) as d from c where r < 10 group by all) group by all)
        select 'http://t.example.org/' || n || '/' || k as url, case when k = 1 then 'FIRST_ROW' else 'NONE' end as header_position, case when k = 1 or by_column <= by_row then 'HORIZONTAL' else 'VERTICAL' end as orientation,
            'T' as page_title, 'On 12-05-2010 it was so.' as before, 'no date' as after, (case when k = 1 or by_column <= by_row then rows else 3 end)::int as rows, 1 as dated_before, 0 as dated_after from h join x using (n, k) join y using (n, k)""",
    "lenient_tables": r"""
        with o as (select *, (c_custkey // 3) % 6 as k, row_number() over (partition by c_nationkey, (c_custkey // 3) % 6 order by c_custkey) as place from customer),
        c as (select 'http://t.example.org/' || c_nationkey || '/' || k as url, k, place, c_name, c_mktsegment, floor(c_acctbal)::bigint::varchar as balance from o where k <> 3 or place <= 2),
        w as (select url, unnest(regexp_extract_all(lower(c_name || ' ' || c_mktsegment || ' ' || balance), '[a-z0-9]+')) as term from c
              union all select url, unnest(['12', '05', '2010', 'so', 'date']) from (select distinct url from c)
              union all select url, unnest(['segment', 'balance']) from (select distinct url from c where k = 1)),
        f as (select url, term, row_number() over (partition by url order by count(*) desc, term) as place from w group by url, term),
        t as (select url, string_agg(term, ' ' order by term) as terms from f where place <= 100 group by url),
        g as (select url, any_value(k) as k, count(*) + any_value(k = 1)::int as rows, arg_max(c_name, place) as last from c group by url)
        select url, case when k = 4 then 4 else 3 end as columns, rows::int as rows, k = 1 as has_header, case when k = 1 then 'FIRST_ROW' else 'NONE' end as header_position, last, terms
        from g join t using (url) where k <> 2 and rows >= 2""",
    "table_features": _features_sql(),
}
