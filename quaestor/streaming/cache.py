"""A cache with time to live as a stream: state per key, reads answered from it, expiry by timers."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
ANSWER = "key string, id bigint, at timestamp, what string, body string, hits bigint"


@contextlib.contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """The state store that timers need, for the streams that are started within."""
    before = spark.conf.get(PROVIDER[0], None)
    spark.conf.set(*PROVIDER)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER[0]) if before is None else spark.conf.set(PROVIDER[0], before)


class _Cache(StatefulProcessor):
    """One key's entry. Times are milliseconds; an entry lives up to and with the moment of its expiry."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "body string, until bigint, hits bigint")

    def _drop_timers(self) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows), ignore_index=True).sort_values(["at", "id"], kind="stable")
        entry = self.held.get() if self.held.exists() else None
        out, purged = [], False
        for e in events.itertuples(index=False):
            now = int(e.at.value // 1_000_000)
            if entry is not None and entry[1] < now:
                # what expired before this event goes first, timer or not
                out.append((key[0], None, pd.Timestamp(entry[1], unit="ms"), "purged", None, entry[2]))
                entry, purged = None, True
            if e.op == "put":
                if e.body:  # an empty answer is never kept
                    entry = (e.body, now + int(e.ttl_s) * 1000, 0)
            elif entry is None:
                out.append((key[0], e.id, e.at, "miss", None, 0))
            else:
                entry = (entry[0], entry[1], entry[2] + 1)
                out.append((key[0], e.id, e.at, "hit", entry[0], entry[2]))
        self._drop_timers()
        if entry is None:
            self.held.clear()
        else:
            self.held.update(entry)
            self.handle.registerTimer(entry[1] + 1)
        yield pd.DataFrame(out, columns=["key", "id", "at", "what", "body", "hits"]).astype({"id": "Int64"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out = []
        if self.held.exists():
            body, until, hits = self.held.get()
            if until < expiredTimerInfo.getExpiryTimeInMs():
                out.append((key[0], None, pd.Timestamp(until, unit="ms"), "purged", None, hits))
                self.held.clear()
        yield pd.DataFrame(out, columns=["key", "id", "at", "what", "body", "hits"]).astype({"id": "Int64"})

    def close(self) -> None:
        pass


def answered(events: DataFrame, late: str = "0 seconds") -> DataFrame:
    """Hits and misses of the reads, and what is purged, of a stream of (key, id, at, op, body, ttl_s); op is put or get.

    A key's events are taken by time and id. A put replaces and starts the count of hits anew; an entry whose time has passed is purged by the
    next event of its key or by its timer, once the watermark has passed it: state holds live entries only. Events later than ``late``
    are dropped. Start the query within ``keyed_state``.
    """
    seen = events.withWatermark("at", late).select(F.col("key").cast("string").alias("key"), F.col("id").cast("bigint").alias("id"), "at", "op", "body", F.col("ttl_s").cast("bigint").alias("ttl_s"))
    return seen.groupBy("key").transformWithStateInPandas(_Cache(), ANSWER, "Append", "EventTime")
