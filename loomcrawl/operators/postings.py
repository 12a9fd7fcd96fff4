"""An inverted index of posting blocks, and lookups of documents that hold several terms.

A term's documents are cut at fixed ranges of ids, the same for all terms. A block is a row: field, term, range, smallest and
largest id, their number, the ids as differences, and the frequencies. A hot term has many blocks, none longer than a
range, which a range sort deals to many files; files are sorted by field, term and range, so that a lookup of
a term reads few row groups. A lookup first joins the blocks' heads by range, keeps ranges in which all terms
have documents between overlapping bounds, and unpacks those alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from loomcrawl.operators.relations import row_terms, text_index
from loomcrawl.operators.scratch import saved, scratch_path

#: Ids of a range, as a power of two: a block has 65,536 postings at most.
RANGE_BITS = 16


#: Of a block, in the order of its rows.
_BLOCK = "field string, term string, range long, first long, last long, df int, gaps array<int>, tfs array<int>"


def _rows(index: DataFrame, doc_id: str, range_bits: int) -> DataFrame:
    """(field, term, range, id, tf) of an index's rows."""
    rows = index.where(F.col("term").isNotNull() & F.col(doc_id).isNotNull())
    return rows.select("field", "term", F.shiftright(F.col(doc_id).cast("long"), range_bits).alias("range"), F.col(doc_id).cast("long").alias("id"), F.col("tf").cast("int").alias("tf"))


def _packed(dealt: DataFrame, range_bits: int) -> DataFrame:
    """Blocks of rows that are dealt by field, term and range: neighbours in their order, batch by batch."""

    def differ(x: pa.Array) -> np.ndarray:
        codes = x.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False) if pa.types.is_string(x.type) else x.to_numpy()
        return np.concatenate(([True], codes[1:] != codes[:-1]))

    def blocks(t: pa.Table) -> pa.RecordBatch:
        field, term, rng, ids, tf = (t.column(k).combine_chunks() for k in range(5))
        opens = differ(field) | differ(term) | differ(rng)
        rows = np.flatnonzero(opens | differ(ids))  # several rows of a document and term are one posting
        at, tfs = ids.to_numpy()[rows], np.add.reduceat(tf.to_numpy(), rows)
        starts = np.flatnonzero(opens[rows])
        ends, of = np.append(starts[1:], len(rows)), rng.to_numpy()[rows[starts]]
        gaps = np.diff(at, prepend=0)
        gaps[starts] = at[starts] - (of << range_bits)
        cuts = pa.array(np.append(starts, len(rows)), pa.int32())
        heads = pa.array(rows[starts])
        lists = [pa.ListArray.from_arrays(cuts, pa.array(x.astype(np.int32))) for x in (gaps, tfs)]
        return pa.RecordBatch.from_arrays([field.take(heads), term.take(heads), pa.array(of), pa.array(at[starts]), pa.array(at[ends - 1]), pa.array((ends - starts).astype(np.int32)), *lists], ["field", "term", "range", "first", "last", "df", "gaps", "tfs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            opens = np.logical_or.reduce([differ(t.column(k).combine_chunks()) for k in range(3)])
            last = int(np.flatnonzero(opens)[-1])  # the next batch may go on with it
            held = t.slice(last)
            if last:
                yield blocks(t.slice(0, last))
        if held is not None:
            yield blocks(held)

    # by term first: its first bytes settle most comparisons, those of a field none
    return dealt.sortWithinPartitions("term", "field", "id").mapInArrow(run, _BLOCK)


def posting_blocks(index: DataFrame, doc_id: str = "doc_id", range_bits: int = RANGE_BITS) -> DataFrame:
    """(field, term, range, first, last, df, gaps, tfs) from (field, term, doc_id, tf); doc_id is a long. Rows of one document and term are added up.

    gaps: the first id of the range's own, then differences; rows with a null term or id are left out.
    """
    return _packed(_rows(index, doc_id, range_bits).repartition("field", "term", "range"), range_bits)


def write_postings(index: DataFrame, path: str, doc_id: str = "doc_id", range_bits: int = RANGE_BITS) -> None:
    """Posting blocks as Parquet below path/field=NAME, in ranges of (field, term, range). Rows move once."""
    order = ["field", "term", "range"]
    # written, as dealing by ranges reads its input twice
    rows = saved(_rows(index, doc_id, range_bits), "posting-rows")
    _packed(rows.repartitionByRange(*order), range_bits).sortWithinPartitions(*order).write.partitionBy("field").parquet(path)


@F.arrow_udf(ArrayType(LongType()))
def _ids(start: pa.Array, gaps: pa.Array) -> pa.Array:
    """The ids of blocks: running sums of their gaps."""
    size, flat = np.asarray(gaps.value_lengths()), gaps.flatten().to_numpy().astype(np.int64)
    ends = np.cumsum(size)
    total = np.concatenate(([0], np.cumsum(flat)))
    own = np.repeat(start.to_numpy() - total[ends - size], size)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(total[1:] + own))


def postings(blocks: DataFrame, range_bits: int = RANGE_BITS) -> DataFrame:
    """(field, term, doc_id, tf) from blocks."""
    ids = blocks.withColumn("ids", _ids(F.shiftleft(F.col("range"), range_bits), F.col("gaps")))
    return ids.select("field", "term", F.explode(F.arrays_zip("ids", "tfs")).alias("p")).select("field", "term", F.col("p.ids").alias("doc_id"), F.col("p.tfs").alias("tf"))


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("field", F.col("field").cast("string"))


def lookup(blocks: DataFrame, field: str, terms: list[str], range_bits: int = RANGE_BITS) -> DataFrame:
    """(doc_id, tf): documents that hold all the terms in a field, and the sum of their frequencies there. No terms: no documents."""
    wanted = sorted(set(terms))
    found = blocks.where((F.col("field") == field) & F.col("term").isin(*wanted))
    heads = found.groupBy("range").agg(F.count("*").alias("n"), F.max("first").alias("low"), F.min("last").alias("high"))
    ranges = heads.where((F.col("n") == len(wanted)) & (F.col("low") <= F.col("high"))).select(F.col("range").alias("_range"), "low", "high")
    kept = found.join(ranges, F.col("range") == F.col("_range"))
    hits = postings(kept.select("field", "term", "range", "gaps", "tfs"), range_bits)
    return hits.groupBy("doc_id").agg(F.sum("tf").alias("tf"), F.count("*").alias("n")).where(F.col("n") == len(wanted)).drop("n")


# Queries

#: Of every text, as words of ASCII letters; each is in a quarter of the documents or more.
LOOKED_UP = ("from", "thre", "tion")


def _words(text: Column) -> Column:
    return F.array_join(F.regexp_extract_all(F.lower(text), F.lit("[a-z]{3,}"), F.lit(0)), " ")


def term_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index of all documents, written and looked up; ranges of 64 ids, so that a frequent term has many blocks here too."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = scratch_path(spark, "postings")
    write_postings(row_terms(d, "doc_id", {"text": _words(F.col("text")), "source": F.col("source")}), path, range_bits=6)
    return lookup(read_postings(spark, path), "text", list(LOOKED_UP), 6)


def posting_block_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the index of names of parts is cut: blocks of a term, their postings, and bounds."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    blocks = posting_blocks(text_index(p, "p_partkey", {"name": F.regexp_replace("p_name", "[^A-Za-z0-9]+", " ")}), "p_partkey", 8)
    return blocks.select("term", "range", "first", "last", "df", F.aggregate("tfs", F.lit(0).cast("long"), lambda a, x: a + x).alias("tf"), F.aggregate("gaps", F.lit(0).cast("long"), lambda a, x: a + x).alias("gap_sum"))


QUERIES = {f.__name__: f for f in (term_lookup, posting_block_heads)}
_STOP = "'a','an','and','are','as','at','be','but','by','for','if','in','into','is','it','no','not','of','on','or','such','that','the','their','then','there','these','they','this','to','was','will','with'"
ORACLE_SQL = {
    "term_lookup": "with w as (select doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) as t from documents) "
    f"select doc_id, count(*)::bigint as tf from w where t in ({', '.join(repr(t) for t in LOOKED_UP)}) group by doc_id having count(distinct t) = {len(LOOKED_UP)}",
    "posting_block_heads": f"""with w as (select p_partkey, unnest(regexp_extract_all(lower(p_name), '[a-z0-9]+')) as term from part),
        t as (select term, p_partkey, count(*) as tf from w where term not in ({_STOP}) group by all)
        select term, p_partkey // 256 as range, min(p_partkey) as first, max(p_partkey) as last, count(*)::int as df, sum(tf)::bigint as tf, max(p_partkey) - p_partkey // 256 * 256 as gap_sum from t group by term, p_partkey // 256""",
}
