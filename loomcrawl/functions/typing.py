"""Types of cells and columns of web tables, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a number looks like, and how specific each type is.
CURRENCY = r"-?\s*([$£₤]\s*[\d,]+(\.\d+)?)|([\d,]+(\.\d+)?\s*[€])"
DOUBLE = r"-?[\d,]+\.\d+(\s)?(%)?"
INTEGER = r"(^|[^\d])-?[\d,]{1,9}(\s)?(%)?($|[^\d])"
LONG = r"-?[\d,]+"
SPECIFICITY = {"none": -1, "string": 0, "email": 1, "url": 2, "datetime": 3, "double": 4, "long": 6, "integer": 7, "currency": 8}
NUMERIC_SHARE = 0.6
MAJORITY_GAP = 0.40
NUMERIC_COLUMN = 0.9


def cell_type(cell: Column) -> Column:
    """none, currency, double, integer, long or string: the first number pattern whose first match covers over 60 % of the cell."""
    covers = lambda p: F.length(F.regexp_substr(cell, F.lit(p))) / F.length(cell) > NUMERIC_SHARE
    return F.when(cell.isNull() | (cell == ""), "none").when(covers(CURRENCY), "currency").when(covers(DOUBLE), "double").when(covers(INTEGER), "integer").when(covers(LONG), "long").otherwise("string")


def specificity(kind: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in SPECIFICITY.items() for x in kv)), kind)


def column_types(cells: DataFrame, by: list[str], cell: str) -> DataFrame:
    """(by…, type) by vote over the cells of each column.

    Empty cells do not vote but count in the column's length. One type alone wins; else the most
    frequent one if it leads by over 40 % of the length, ties to the less specific; else, if over 90 %
    are numbers, the least specific number type; else string.
    """
    n = cells.groupBy(*by, cell_type(F.col(cell)).alias("type")).agg(F.count("*").alias("n"))
    votes = F.filter(F.sort_array(F.collect_list(F.struct("n", (-specificity(F.col("type"))).alias("s"), "type")), asc=False), lambda v: v["type"] != "none")
    c = n.groupBy(*by).agg(F.sum("n").alias("length"), votes.alias("v"))
    numbers = F.filter("v", lambda v: v["s"] <= -SPECIFICITY["double"])
    share = F.aggregate(numbers, F.lit(0).cast("long"), lambda a, v: a + v["n"]) / F.col("length")
    least = F.element_at(F.sort_array(F.transform(numbers, lambda v: F.struct((-v["s"]).alias("s"), v["type"].alias("type")))), 1)["type"]
    gap = (F.element_at("v", 1)["n"] - F.element_at("v", 2)["n"]) / F.col("length")
    kind = F.when(F.size("v") == 0, "none").when(F.size("v") == 1, F.element_at("v", 1)["type"]).when(gap > MAJORITY_GAP, F.element_at("v", 1)["type"]).when(share > NUMERIC_COLUMN, least).otherwise("string")
    return c.select(*by, kind.alias("type"))


def cell_pattern(cell: Column) -> Column:
    """Runs of letters as a, of digits as d, of other signs as s, of punctuation and space as p."""
    # fixed values; letters and digits become a and d first, so the later classes leave a and d out
    for pattern, to in ((r"[a-zA-Z]+", "a"), (r"[0-9]+", "d"), (r"[^ad\s.!;():?,\-'\"]+", "s"), (r"[\s.!;():?,\-'\"]+", "p")):
        cell = F.regexp_replace(cell, pattern, to)
    return cell


def numeric_only(cell: Column) -> Column:
    return cell.try_cast("double").isNotNull()


def string_only(cell: Column) -> Column:
    """Letters and no digits; null counts as empty."""
    return F.coalesce(cell.rlike(r"\p{IsAlphabetic}") & ~cell.rlike(r"\p{Nd}"), F.lit(False))
