"""Where the outside world plugs in: protocols, and stubs that behave the same every time."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


class Fetcher(Protocol):
    def __call__(self, url: str) -> str | None: ...


class Classifier(Protocol):
    def __call__(self, texts: list[str]) -> list[dict]: ...


class Notifier(Protocol):
    def __call__(self, message: str) -> bool: ...


class ObjectStore(Protocol):
    def put(self, key: str, data: bytes) -> str: ...


def stub_classifier(texts: list[str]) -> list[dict]:
    """Relevance and confidence from a hash of the text."""
    out = []
    for t in texts:
        h = hashlib.sha256((t or "").encode()).digest()
        out.append({"relevance": h[0] % 101, "llm_confidence": h[1] % 101 / 100})
    return out


class MemoryStore:
    def __init__(self):
        self.held: dict[str, bytes] = {}

    def put(self, key: str, data: bytes) -> str:
        self.held[key] = data
        return hashlib.sha256(data).hexdigest()


def write_archive(df: DataFrame, path: str, part: str, columns: list[str]) -> None:
    """JSON lines by part, each part's files sorted by its own rows."""
    df.select(part, F.to_json(F.struct(*columns)).alias("value")).write.partitionBy(part).text(path)


def fetched(df: DataFrame, url: str, fetch: Fetcher, retries: int = 4) -> DataFrame:
    """df with body, null where nothing came. fetch is asked again, up to `retries` times in all, while it raises; it returns null for what is no use asking for."""

    def body(u: str | None) -> str | None:
        for _ in range(retries if u else 0):
            try:
                return fetch(u)
            except Exception:  # noqa: BLE001  a source may fail in any way
                continue
        return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(body=[body(u) for u in pdf[url]])

    return df.mapInPandas(run, StructType([*df.schema.fields, StructField("body", StringType())]))


class Bucket:
    """A token bucket: take() gives the seconds to wait. The clock is a parameter."""

    def __init__(self, rate: float, burst: float, clock: Callable[[], float]):
        self.rate, self.burst, self.clock, self.held, self.at = rate, burst, clock, burst, clock()

    def take(self, n: float = 1.0) -> float:
        now = self.clock()
        self.held, self.at = min(self.burst, self.held + (now - self.at) * self.rate) - n, now
        return max(0.0, -self.held / self.rate)
