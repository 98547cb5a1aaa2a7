"""A watchdog over heartbeats: a page when a source has been silent too long, and again while the silence lasts; as a batch and as a stream with timers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

HOUR = 3_600_000
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def pages(df: DataFrame, source: str, at: str, until: int, silence: int = 3 * HOUR, again: int = 2 * HOUR) -> DataFrame:
    """(source, last_seen, paged_at), in milliseconds: a page when a source has sent nothing for `silence`, then one each `again` until it sends or `until` is reached. A heartbeat at the very moment of a page
    prevents it. Repeated heartbeats count once; rows without source or time don't count."""
    beats = df.where(F.col(source).isNotNull() & F.col(at).isNotNull() & (F.col(at) <= until)).select(F.col(source).alias("source"), F.col(at).cast("long").alias("last_seen")).distinct()
    end = F.coalesce(F.lead("last_seen").over(Window.partitionBy("source").orderBy("last_seen")), F.lit(until + 1))
    gaps = beats.withColumn("end", end).where(F.col("end") > F.col("last_seen") + silence)
    return gaps.select("source", "last_seen", F.explode(F.sequence(F.col("last_seen") + silence, F.col("end") - 1, F.lit(again).cast("long"))).alias("paged_at"))


class Watchdog(StatefulProcessor):
    """State of a source: heartbeats not yet out of sight, and how far pages are decided. Each heartbeat sets a timer at the end of its silence; a page sets the next."""

    def __init__(self, silence: int = 3 * HOUR, again: int = 2 * HOUR):
        self.silence, self.again = silence, again

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.beats = handle.getListState("beats", "at long")
        self.decided = handle.getValueState("decided", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        done = self.decided.get()[0] if self.decided.exists() else None
        old = {r[0] for r in self.beats.get()} if self.beats.exists() else set()
        new = {int(t) for pdf in rows for t in pdf["beat"].tolist()} - old
        every = sorted(old | new)
        # what lies further back than a silence before the last decision is out of sight, but for the newest, from which a silence may go on
        before = max((t for t in every if done is not None and t <= done), default=None)
        self.beats.put([(t,) for t in every if done is None or t > done - self.silence or t == before])
        for t in new:
            self.handle.registerTimer(t + self.silence)
        yield pd.DataFrame({"source": [], "last_seen": [], "paged_at": []}).astype({"source": "str", "last_seen": "int64", "paged_at": "int64"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, due = timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()
        beats = [r[0] for r in self.beats.get()]
        out = []
        while due <= now:
            seen = max((t for t in beats if t <= due), default=None)
            if seen is None or seen > due - self.silence:
                break  # its own timer decides
            out.append((key[0], seen, due))
            due += self.again
        else:
            self.handle.registerTimer(due)
        self.decided.update((max(now, self.decided.get()[0] if self.decided.exists() else now),))
        yield pd.DataFrame(out, columns=["source", "last_seen", "paged_at"]).astype({"source": "str", "last_seen": "int64", "paged_at": "int64"})

    def close(self) -> None:
        pass


def paging(df: DataFrame, source: str, at: str, delay: str = "10 minutes", silence: int = 3 * HOUR, again: int = 2 * HOUR) -> DataFrame:
    """pages() as a stream of (source, last_seen, paged_at): `at` is a timestamp, pages leave once the watermark, `delay` behind the newest heartbeat of any source, has passed them. State lives in the checkpoint; a source costs its
    heartbeats of one silence. The session's state store has to be RocksDB (`ROCKS`)."""
    beats = df.where(F.col(source).isNotNull() & F.col(at).isNotNull()).select(F.col(source).cast("string").alias("source"), F.col(at).alias("at"), F.unix_millis(at).alias("beat"))
    return beats.withWatermark("at", delay).groupBy("source").transformWithStateInPandas(Watchdog(silence, again), "source string, last_seen long, paged_at long", "append", "eventTime")
