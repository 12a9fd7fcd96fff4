"""A training-corpus pipeline over `documents`, in five stages.

Quality rules reject documents; of exact copies one stays; of near-duplicate groups one stays;
sources are mixed to target weights, documents leaving in as many copies as the mix takes; and what
is left is packed into token sequences. Every stage reads all that its predecessor kept. All but the
last return the columns of `documents`; the last returns one row per piece with its token ids and its
place in a sequence. Empty inputs give empty outputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomcrawl.llm.common import saved, table
from loomcrawl.llm.exact_dedup import drop_exact_duplicates
from loomcrawl.llm.mixing import mix_documents
from loomcrawl.llm.packing import PackParams, pack
from loomcrawl.llm.quality import keep_good
from loomcrawl.llm.registry import tokenizer_file
from loomcrawl.llm.simhash import drop_near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, PackParams(tokenizer_file("word_bpe_49k.json")))


STAGES = [("quality rules", quality), ("exact dedup", exact), ("near-dedup", near), ("mixing", mixed), ("packing", packed)]

#: Fingerprints, a fitted model and token ids are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs, name.replace(" ", "-"))
    return docs
