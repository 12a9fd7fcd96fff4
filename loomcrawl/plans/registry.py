"""Registered queries: name -> function of (spark, sf_dir), and the SQL that states the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomcrawl.operators import cooc, entities, links, postings, prefixes, profile, quads, relations, structured_data, user_aggregates, web_tables
from loomcrawl.plans import exchange
from loomcrawl.streaming import queries as streams

MODULES = (links, quads, prefixes, entities, profile, cooc, relations, postings, user_aggregates, structured_data, web_tables, streams, exchange)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLE_SQL: dict[str, str] = {k: v for m in MODULES for k, v in m.ORACLE_SQL.items()}
