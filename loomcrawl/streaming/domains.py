"""Counters of domains from a stream of page profiles: a map of formats per domain as state, flushed when a domain goes quiet."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

TOTALS = "domain string, format string, triples long, urls long"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class DomainCounters(StatefulProcessor):
    """Of one domain: the triples and urls of each format since it was flushed last, and a timer that each batch moves on."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "format string", "triples long, urls long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        timers = list(self.handle.listTimers())
        for t in timers:
            self.handle.deleteTimer(t)
        if timers and max(timers) <= timerValues.getCurrentWatermarkInMs():  # quiet for long, and back before the timer was asked
            yield self._flushed(key)
            timers = []
        last = 0
        for batch in rows:
            last = max(last, int(batch["at"].max()))
            for name, some in batch.groupby("format"):
                known = self.counts.getValue((name,)) or (0, 0)
                self.counts.updateValue((name,), (known[0] + int(some["triples"].sum()), known[1] + len(some)))
        self.handle.registerTimer(max([last + self.idle_ms, *timers]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._flushed(key)

    def _flushed(self, key) -> pd.DataFrame:
        found = [(key[0], name[0], *n) for name, n in self.counts.iterator()]
        self.counts.clear()
        # as plain objects: strings kept by Arrow come in chunks, which Spark's writer does not take
        return pd.DataFrame(found, columns=["domain", "format", "triples", "urls"]).astype({"domain": object, "format": object})

    def close(self) -> None:
        pass


def use_state(spark: SparkSession) -> None:
    """State with timers and maps needs Spark's store on RocksDB; set before the query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def domain_totals(profile: DataFrame, ts: str = "ts", delay: str = "10 minutes", idle: str = "1 hour") -> DataFrame:
    """(domain, format, triples, urls): partial sums of each domain, made when the watermark is `idle` past its last row.

    profile: a stream of domain, format, triples and an event time. State is a row per format of domains that are not
    quiet, however long the stream is; a domain that comes back begins anew. The sums of all partial sums are those of a batch
    over the same rows, late ones behind the watermark aside.
    """
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)
    timed = profile.withWatermark(ts, delay).select("domain", "format", "triples", ts, F.unix_millis(F.col(ts)).alias("at"))
    return timed.groupBy("domain").transformWithStateInPandas(statefulProcessor=DomainCounters(idle_ms), outputStructType=TOTALS, outputMode="Append", timeMode="EventTime")
