"""Streams over the same rules as the batch operators: late data, suppression claims, quiet sessions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.alerts import fold_suppression


def on_time(df: DataFrame, published: str, ingested: str, days: int = 2) -> DataFrame:
    """Watermarked by publication; what arrives more than `days` after it is dropped."""
    return df.withWatermark(published, f"{days} days").where(F.col(published) >= F.col(ingested) - F.expr(f"INTERVAL {days} DAYS"))


def suppression(df: DataFrame, key: str, id_col: str, micros: str, tier_rank: str, hours: int = 4, forget: bool = False) -> DataFrame:
    """(id, blocked) as a stream. The claim of each key is (rank, expiry).

    forget: keys silent for twice `hours` lose their state, for streams that run on; a run that ends when its input does would wait for that for ever.
    """

    def run(_: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches)).sort_values(["t", "i"])
        told, now = fold_suppression(list(zip(rows["i"].tolist(), rows["t"].tolist(), rows["r"].tolist(), strict=True)), tuple(state.get) if state.exists else None, hours)
        if now is not None:
            state.update(now)
            if forget:
                state.setTimeoutDuration(2 * hours * 3_600_000)
        yield pd.DataFrame(told, columns=["id", "blocked"])

    rows = df.where(F.col(tier_rank) > 0).select(F.col(key).alias("k"), F.col(id_col).cast("long").alias("i"), F.col(micros).cast("long").alias("t"), F.col(tier_rank).cast("int").alias("r"))
    return rows.groupBy("k").applyInPandasWithState(run, "id long, blocked boolean", "rank int, expires long", "append", GroupStateTimeout.ProcessingTimeTimeout if forget else GroupStateTimeout.NoTimeout)


def quiet_sessions(df: DataFrame, group: str, time: str, hours: int = 12, delay: str = "1 hour") -> DataFrame:
    """Sessions of pages by storyline; a session's end is its closure, sent once the watermark passes it."""
    return df.withWatermark(time, delay).groupBy(group, F.session_window(time, f"{hours} hours").alias("s")).agg(F.count("*").alias("pages")).select(group, F.col("s.start").alias("opened"), F.col("s.end").alias("closed"), "pages")


def matured(df: DataFrame, ingested: str, hours: int = 2) -> DataFrame:
    """Rows old enough when their batch runs; younger ones come again with a later one from a replayable source."""
    return df.where(F.col(ingested) < F.current_timestamp() - F.expr(f"INTERVAL {hours} HOURS"))
