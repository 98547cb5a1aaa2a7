"""Quality rules with adaptive thresholds from mergeable quantile sketches per language and source, then a joined filter.

One pass over the texts gives each document its counts, written once. Of the counts, four rates are judged: symbols per
word, characters per word, lines repeated and words repeated. Each task folds the rates of its rows into one sketch for
each (lang, source): a KLL sketch, whose compaction keeps every second item, so that two sketches merge into one with the
same error. A task sends its sketches on when it holds HELD of them. Sketches are merged as a tree: as long as a group has more than FAN, its sketches are dealt over as many
salts as leave about FAN / 2 for each, so nothing ever loads more, however many tasks and sources there are. The fences drawn from a group's quartiles are joined back.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Scratch, as_bytes, lean, ready, slices, table, written
from ._words import SPACED, Words, windows

RATES = ("symbol_rate", "word_length", "line_rate", "repeat_rate")
#: Spreads from the median to a fence, and rows a group needs to be judged by its own quantiles.
WIDTH, ENOUGH = 8.0, 50
FAN, HELD, MOST_GROUPS = 256, 512, 200_000


class Kll:
    """Mergeable quantile sketch: levels[i] holds items of weight 2**i; compaction alternates parity. What it holds depends on the order in which it met its items; a rank is off by 1 % at most (tested)."""

    def __init__(self, k: int = 800, levels: list[np.ndarray] | None = None, flips: int = 0):
        self.k, self.levels, self.flips = k, levels or [np.zeros(0)], flips

    @property
    def n(self) -> int:
        return sum(len(x) << i for i, x in enumerate(self.levels))

    def add(self, values: np.ndarray) -> Kll:
        for i in range(0, len(values), 4 * self.k):
            self.levels[0] = np.concatenate([self.levels[0], values[i : i + 4 * self.k]])
            self._compact()
        return self

    def merge(self, other: Kll) -> Kll:
        while len(self.levels) < len(other.levels):
            self.levels.append(np.zeros(0))
        for i, x in enumerate(other.levels):
            self.levels[i] = np.concatenate([self.levels[i], x])
        self.flips += other.flips
        return self._compact()

    def _compact(self) -> Kll:
        i = 0
        while i < len(self.levels):
            x = self.levels[i]
            room = max(8, int(self.k * (2 / 3) ** (len(self.levels) - 1 - i)))
            if len(x) > room:
                x = np.sort(x)
                odd = x[len(x) & ~1 :]
                if i + 1 == len(self.levels):
                    self.levels.append(np.zeros(0))
                self.levels[i + 1] = np.concatenate([self.levels[i + 1], x[: len(x) & ~1][self.flips & 1 :: 2]])
                self.levels[i] = odd
                self.flips += 1
            i += 1
        return self

    def quantiles(self, at: list[float]) -> list[float]:
        """Nearest ranks; nan of an empty sketch."""
        x = np.concatenate(self.levels)
        if not len(x):
            return [float("nan")] * len(at)
        w = np.concatenate([np.full(len(v), 1 << i, np.int64) for i, v in enumerate(self.levels)])
        order = np.argsort(x, kind="stable")
        run = np.cumsum(w[order])
        return [float(x[order][min(len(x) - 1, int(np.searchsorted(run, q * run[-1])))]) for q in at]

    def upper(self) -> tuple[float, float]:
        """The median, and the middle one of the values above it: the upper quartile, unless many values equal the median. Both are the median if none lies above."""
        (mid,) = self.quantiles([0.5])
        above = Kll(self.k, [x[x > mid] for x in self.levels])
        return mid, above.quantiles([0.5])[0] if above.n else mid

    def dump(self) -> bytes:
        head = struct.pack(f"<III{len(self.levels)}I", self.k, self.flips & 1, len(self.levels), *map(len, self.levels))
        return head + np.concatenate(self.levels).astype("<f8").tobytes()

    @classmethod
    def load(cls, data: bytes) -> Kll:
        k, flips, n = struct.unpack_from("<III", data)
        sizes = struct.unpack_from(f"<{n}I", data, 12)
        x = np.frombuffer(data, "<f8", offset=12 + 4 * n)
        ends = np.cumsum(sizes)
        return cls(k, [x[e - s : e].copy() for s, e in zip(sizes, ends, strict=True)], flips)


_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _point_counts(buf: np.ndarray, at: np.ndarray, where: np.ndarray) -> np.ndarray:
    run = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(where, out=run[1:])
    return run[at[1:]] - run[at[:-1]]


def _repeated(h: np.ndarray, n: int) -> int:
    """Words inside n-word windows that occur twice or more, the first occurrence included."""
    if len(h) <= n:
        return 0
    x = windows(h, n)
    _, back, count = np.unique(x, return_inverse=True, return_counts=True)
    hit = count[back] > 1
    if not hit.any():
        return 0
    edge = np.zeros(len(h) + 1, np.int64)
    edge[:-n] += hit
    edge[n:] -= hit
    return int((np.cumsum(edge[:-1]) > 0).sum())


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


@lean
def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for b in slices(whole, "text"):
            texts = as_bytes(b.column("text"))
            w = Words(texts, lower=False)
            buf = np.frombuffer(w.buf, np.uint8)
            chars = _point_counts(buf, w.at, SPACED[buf] & ((buf & 0xC0) != 0x80))
            symbols = _point_counts(buf, w.at, _SYMBOL[buf])
            repeat = [_repeated(w.hash[p:q], 8) for p, q in zip(w.ptr[:-1], w.ptr[1:], strict=True)]
            cols = [np.diff(w.ptr), chars, symbols, [_dup_lines(t) for t in texts], repeat, [t.count(b"\n") + 1 for t in texts]]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("lang"), b.column("source"), *(pa.array(x, pa.int64()) for x in cols)],
                ["id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"],
            )


def _sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One sketch of each rate for each (lang, source) of a partition."""
    held: dict[tuple, list[Kll]] = {}

    def rows() -> pd.DataFrame:
        out = [(a, b, *(s.dump() for s in own)) for (a, b), own in held.items()]
        held.clear()
        return pd.DataFrame(out, columns=["lang", "source", *RATES])

    for pdf in batches:
        for key, part in pdf.groupby(["lang", "source"], dropna=False, sort=False):
            own = held.setdefault(tuple(None if pd.isna(x) else x for x in key), [Kll() for _ in RATES])
            for s, r in zip(own, RATES, strict=True):
                s.add(part[r].to_numpy(float))
            if len(held) >= HELD:
                yield rows()
    yield rows()


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    out = pdf.iloc[:1].copy()
    for r in RATES:
        s = Kll()
        for x in sorted(pdf[r]):
            s.merge(Kll.load(x))
        out[r] = [s.dump()]
    return out


def _merged(parts: DataFrame, by: list[str], scratch: Scratch) -> DataFrame:
    """parts (by, RATES), merged until no group has more than FAN sketches. No task gets more than about FAN of one group."""
    names = ", ".join(f"{c} string" for c in by)
    binaries = ", ".join(f"{r} binary" for r in RATES)
    while (most := parts.groupBy(*by).agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]) > FAN:
        salted = parts.withColumn("salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(-(-2 * most // FAN))).cast("int"))
        parts = scratch.written(salted.groupBy(*by, "salt").applyInPandas(_merge, f"{names}, {binaries}, salt int").drop("salt"))
    return parts


def fence(median: float, upper: float) -> float:
    """WIDTH times as far above the median as the middle of what lies above it; none (infinite) where nothing does."""
    return median + WIDTH * (upper - median) if upper > median else float("inf")


def _fences(pdf: pd.DataFrame) -> pd.DataFrame:
    out = _merge(pdf)
    sketch = [Kll.load(out[r].iloc[0]) for r in RATES]
    for r, s in zip(RATES, sketch, strict=True):
        out[f"{r}_top"] = fence(*s.upper())
    return out.assign(n=sketch[0].n).drop(columns=list(RATES))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Counts, fences and verdict: (id_col, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, rates, fences, base_failed, kept), one row per row of docs.

    A document fails at the base with under 20 words, or over 30 % of its words repeated; else it is kept while no rate lies
    above its group's fence: WIDTH times as far above the median as the middle one of the group's rates above it (the upper quartile, unless many equal the median). Rows that fail at the base don't shape the
    fences. A rate that never lies above the group's median is judged by the language's fence, and by none if that holds there too. A group of under ENOUGH such rows is judged by the fences of its language.
    Null and empty texts have no words, so they fail at the base; very long texts are counted whole. Null lang or source is a group like any other. A rate on the fence is kept; ties and
    repeated rows each count. No rows, no result rows. Further columns, whatever their names, are not read.
    """
    ready(docs.sparkSession)
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"))
    longs = ", ".join(f"{c} long" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"))
    counts = base.mapInArrow(_counts, f"id {kind}, lang string, source string, {longs}")
    some = F.greatest("n_words", F.lit(1))
    counts = written(
        counts.select(
            "*",
            (F.col("n_symbols") / some).alias("symbol_rate"),
            (F.col("word_chars") / some).alias("word_length"),
            (F.col("n_dup_lines") / F.col("n_lines")).alias("line_rate"),
            (F.col("n_repeat_words") / some).alias("repeat_rate"),
            ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"),
        )
    )
    binaries = ", ".join(f"{r} binary" for r in RATES)
    tops = ", ".join(f"{r}_top double" for r in RATES)
    with Scratch(docs.sparkSession) as scratch:
        parts = scratch.written(counts.where("not base_failed").select("lang", "source", *RATES).mapInPandas(_sketch, f"lang string, source string, {binaries}"))
        parts = _merged(parts, ["lang", "source"], scratch)
        own = scratch.written(parts.groupBy("lang", "source").applyInPandas(_fences, f"lang string, source string, {tops}, n long"))
        broad = _merged(parts.drop("source"), ["lang"], scratch).groupBy("lang").applyInPandas(_fences, f"lang string, {tops}, n long")
        broad = broad.select(F.col("lang").alias("whole_lang"), *(F.col(f"{r}_top").alias(f"{r}_whole") for r in RATES))
        fences = written(own.join(broad, F.col("lang").eqNullSafe(F.col("whole_lang"))))
    top = lambda r: F.when((F.col("n") >= ENOUGH) & (F.col(f"{r}_top") < float("inf")), F.col(f"{r}_top")).otherwise(F.col(f"{r}_whole")).alias(f"{r}_top")
    fences = F.broadcast(fences) if fences.count() <= MOST_GROUPS else fences  # beyond, Spark splits the groups that are too large for one task
    fences = fences.select(F.col("lang").alias("of_lang"), F.col("source").alias("of_source"), *(top(r) for r in RATES))
    got = counts.join(fences, F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source")), "left")
    within = F.lit(True)
    for r in RATES:
        within = within & (F.col(r) <= F.coalesce(f"{r}_top", F.lit(float("inf"))))
    return got.select(
        F.col("id").alias(id_col), "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *RATES, *(f"{r}_top" for r in RATES), "base_failed", (~F.col("base_failed") & within).alias("kept")
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
