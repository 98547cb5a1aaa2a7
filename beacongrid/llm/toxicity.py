"""Toxicity by maximum-scoring segments over token log-odds, calibrated by extreme-value statistics.

Training: at most about TRAIN_ROWS labelled rows, picked by hash of their id, whose small table is broadcast. Distinct labelled texts are counted once, by document and label, for words and for their prefixes of 4 to 7 bytes. A
feature's weight is its log-odds between labels under a Dirichlet prior in proportion to its overall frequency, less Z standard errors
(the informative prior of Monroe, Colaresi and Quinn 2008). A token scores the highest weight of its word and prefixes, less DRIFT, so
that ordinary tokens score below 0. Features of positive score are those in MIN_DOCS toxic texts or more whose score is over DRIFT; all of them are put, sorted by hash, into a file in the shared folder
that the workers map into memory, however many they are.

Scoring: Ruzzo and Tompa's linear-time scan finds every maximal segment. A segment of score S among n tokens has the expectation
E = K n exp(-lambda S) in clean text (Karlin and Altschul 1990); lambda solves sum(p exp(lambda s)) = 1 on clean tokens and K comes from
clean texts' maxima, as its likeliest value: P(max <= x) = exp(-K n exp(-lambda x)), where a text without a positive token only says that its maximum is below the least positive score. Segments with E under SIGNIFICANT are reported. A logistic curve over the best segment's -log E and the sum of significant
ones turns them into a probability; it is fitted on at most FIT_ROWS training rows, picked by hash of the id. Lambda, K and the curve are
fitted on halves of the texts, each scored by weights that the other half taught, so that they aren't too sure; the final weights come from all.
"""

from __future__ import annotations

import math
import mmap
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Scratch, as_bytes, is_remainder, lean, ready, ship, slices, table
from ._words import LETTERS, Words, mix

PREFIXES = (4, 5, 6, 7)
ALPHA, Z, DRIFT = 50.0, 1.64, 1.5
MIN_DOCS, TRAIN_ROWS, FIT_ROWS = 3, 500_000, 100_000
#: Texts of each label that a half needs to teach what calibrates the other.
APART = 20
SIGNIFICANT = 0.05
SPAN = "array<struct<start:int,end:int,score:double>>"


def features(w: Words) -> list[np.ndarray]:
    """Hashes by word: the word, then its prefixes (0 where the word is not longer)."""
    size = w.end - w.start
    return [w.hash, *(np.where(size > n, mix(w.prefix(n) + np.uint64(n)), np.uint64(0)) for n in PREFIXES)]


@lean
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each label that have a feature; the row of feature 0 counts the texts."""
    held = [{}, {}]

    def rows() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [
                pa.array(np.array([k for part in held for k in part], np.int64)),
                pa.array(np.array([v for v in held[0].values()] + [0] * len(held[1]), np.int64)),
                pa.array(np.array([0] * len(held[0]) + [v for v in held[1].values()], np.int64)),
            ],
            ["f", "clean", "toxic"],
        )
        for part in held:
            part.clear()
        return out

    for whole in batches:
        for b in slices(whole, "text"):
            w = Words(as_bytes(b.column("text")), LETTERS)
            fs = features(w)
            own = w.owner()
            label = np.array(b.column("toxic").to_pylist(), np.int64)
            pair = np.concatenate([np.stack([own.astype(np.uint64), f]) for f in fs], axis=1)
            pair = pair[:, pair[1] != 0]
            order = np.lexsort((pair[1], pair[0]))
            pair = pair[:, order]
            new = np.ones(pair.shape[1], bool)
            new[1:] = (pair[:, 1:] != pair[:, :-1]).any(0)
            pair = pair[:, new]
            of = label[pair[0].astype(np.int64)]
            for k in (0, 1):
                f, n = np.unique(pair[1][of == k].view(np.int64), return_counts=True)
                part = held[k]
                for x, c in zip(f.tolist(), n.tolist(), strict=True):
                    part[x] = part.get(x, 0) + c
                part[0] = part.get(0, 0) + int((label == k).sum())
            if len(held[0]) + len(held[1]) > 400_000:
                yield rows()
    yield rows()


class Scorer:
    """Weights by feature (sorted hashes, then weights, in a file; none without one) and the calibration."""

    def __init__(self, file: str | None, lam: float, k: float, curve: tuple[float, float, float]):
        self.file, self.lam, self.k, self.curve, self.held = file, lam, k, curve, None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "held": None}

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        if self.held is None:
            if self.file is None:
                self.held = np.zeros(0, np.uint64), np.zeros(0)
            else:
                with open(SparkFiles.get(self.file), "rb") as file:
                    data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
                half = len(data) // 16
                self.held = np.frombuffer(data, np.uint64, half), np.frombuffer(data, np.float64, half, 8 * half)
        return self.held

    def tokens(self, w: Words) -> np.ndarray:
        """Score of each word."""
        best = np.full(len(w.hash), -DRIFT)
        f, weight = self.table()
        if len(f):
            for h in features(w):
                at = np.searchsorted(f, h)
                at[at == len(f)] = 0
                best = np.where((f[at] == h) & (h != 0), np.maximum(best, weight[at] - DRIFT), best)
        return best

    def expectation(self, score: float, n: int) -> float:
        return self.k * n * math.exp(-min(700.0, self.lam * score))

    def inputs(self, found: list[tuple[int, int, float]], n: int) -> tuple[float, float]:
        """-log E of the best segment and the sum over significant ones, on a log scale."""
        e = [-math.log(max(1e-300, self.expectation(s, n))) for *_, s in found]
        return math.log1p(max([0.0, *e])), math.log1p(sum(x for x in e if x > -math.log(SIGNIFICANT)))

    def probability(self, found: list[tuple[int, int, float]], n: int) -> float:
        x, y = self.inputs(found, n)
        a, b, c = self.curve
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, a + b * x + c * y))))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, score) in linear time (Ruzzo and Tompa 1999). Only positive tokens are visited; what lies between two of them comes from prefix sums."""
    run = np.concatenate([[0.0], np.cumsum(scores)])
    out: list[tuple[int, int, float, float]] = []  # first, end, sum before, sum through
    for i in np.flatnonzero(scores > 0).tolist():
        now = (i, i + 1, float(run[i]), float(run[i + 1]))
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= now[2]:
                j -= 1
            if j < 0 or out[j][3] >= now[3]:
                out.append(now)
                break
            now = (out[j][0], now[1], out[j][2], now[3])
            del out[j:]
    return [(a, b, r - s) for a, b, s, r in out]


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for b in slices(whole, "text"):
                w = Words(as_bytes(b.column("text")), LETTERS)
                s = model.tokens(w)
                chance, spans, raw = [], [], []
                clear = model.probability([], 1)
                hot = np.add.reduceat(np.append(s > 0, False), w.ptr[:-1]) * (np.diff(w.ptr) > 0) if len(w.ptr) > 1 else []
                for i, (p, q) in enumerate(zip(w.ptr[:-1].tolist(), w.ptr[1:].tolist(), strict=True)):
                    if not hot[i]:
                        chance.append(clear), spans.append([]), raw.append((0.0, 0.0))
                        continue
                    found = maximal_segments(s[p:q])
                    chance.append(model.probability(found, q - p))
                    raw.append(model.inputs(found, q - p))
                    good = [x for x in found if model.expectation(x[2], q - p) <= SIGNIFICANT]
                    if good:
                        at = int(w.at[i])
                        point = np.concatenate([[0], np.cumsum((np.frombuffer(w.buf[at : int(w.at[i + 1])], np.uint8) & 0xC0) != 0x80)])
                        spans.append([{"start": int(point[w.start[p + x] - at]), "end": int(point[w.end[p + y - 1] - at]), "score": v} for x, y, v in good])
                    else:
                        spans.append([])
                raw = np.array(raw).reshape(-1, 2)
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), b.column("held_out"), pa.array(chance, pa.float64()), pa.array(raw[:, 0], pa.float64()), pa.array(raw[:, 1], pa.float64()), pa.array(spans, kind)],
                    ["id", "held_out", "score", "best", "total", "spans"],
                )

    return lean(run)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton's method; slopes aren't negative."""
    a = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -500, 500)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + 0.5 * np.eye(3), a.T @ (y - p) - 0.5 * beta)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(max(0, beta[1])), float(max(0, beta[2]))


def fit(base: DataFrame, marks: DataFrame) -> Scorer:
    """base: (id, text) rows that may teach; marks: (id, toxic 0/1), one row an id, of which at most about TRAIN_ROWS, by hash of the id, are used.

    Repeated texts count once, as toxic if one of them is. Without both labels every text scores the share of toxic ones.
    """
    with Scratch(base.sparkSession) as scratch:
        return _fitted(base, marks, scratch)


def _fitted(base: DataFrame, marks: DataFrame, scratch: Scratch) -> Scorer:
    spark = base.sparkSession
    marks = scratch.written(marks.where("id is not null and toxic in (0, 1)"))
    step = max(1, -(-marks.count() // TRAIN_ROWS))
    marks = marks.where(F.pmod(F.xxhash64("id"), F.lit(step)) == 0)
    base = base.where("text is not null")
    keyed = base.join(F.broadcast(marks), "id").select("id", "toxic", F.xxhash64("text").alias("k"))
    reps = scratch.written(keyed.groupBy("k").agg(F.min("id").alias("id"), F.max("toxic").alias("toxic")))
    again = scratch.written(keyed.groupBy("id", "k").agg(F.count("*").alias("n")).where("n > 1").select("id", "k"))
    data = base.withColumn("k", F.xxhash64("text")).join(F.broadcast(reps), ["id", "k"]).select("id", "k", "text", "toxic")
    if not again.isEmpty():  # rows that repeat an id and its text
        data = data.join(F.broadcast(again), ["id", "k"], "left_anti").unionByName(data.join(F.broadcast(again), ["id", "k"], "left_semi").dropDuplicates(["id", "k"]))
    fold = F.pmod("k", F.lit(2)).cast("int")
    halves = [data.where(fold == j) for j in (0, 1)]
    counted = [h.select("text", "toxic").mapInArrow(_count, "f long, clean long, toxic long").withColumn("fold", F.lit(j)) for j, h in enumerate(halves)]
    counts = scratch.written(counted[0].unionByName(counted[1]).groupBy("f", "fold").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    texts = {j: (r["clean"], r["toxic"]) for j in (0, 1) for r in counts.where((F.col("f") == 0) & (F.col("fold") == j)).collect()}
    n0, n1 = (sum(t[k] for t in texts.values()) for k in (0, 1))
    if not n0 or not n1:
        share = min(1 - 1e-6, max(1e-6, (n1 + 0.5) / (n0 + n1 + 1) if n0 + n1 else 0.01))
        return Scorer(None, 1.0, 1.0, (math.log(share / (1 - share)), 0.0, 0.0))
    model = _weighted(counts.groupBy("f").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), n0, n1)
    # what calibrates a half of the texts is learnt from the other half, where that has enough of both labels
    apart = len(texts) == 2 and min(min(t) for t in texts.values()) >= APART
    judge = [_weighted(counts.where(F.col("fold") == 1 - j), *texts[1 - j]) if apart else model for j in (0, 1)]

    # lambda on clean tokens, counted by rounded score; K from clean texts' expected maxima
    def clean_scores(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for b in slices(whole, "text"):
                    w = Words(as_bytes(b.column("text")), LETTERS)
                    s = np.round(shared.value.tokens(w), 1)
                    v, n = np.unique(s, return_counts=True)
                    top = [max([0.0, *(x for *_, x in maximal_segments(s[p:q]))]) if (s[p:q] > 0).any() else 0.0 for p, q in zip(w.ptr[:-1], w.ptr[1:], strict=True)]
                    m, of = np.unique(np.round(top, 1), return_inverse=True)
                    c, size = np.bincount(of, minlength=len(m)), np.bincount(of, np.diff(w.ptr), len(m)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([v, m])), pa.array(np.concatenate([n, c]), pa.int64()), pa.array(np.concatenate([n, size]), pa.int64()), pa.array([False] * len(v) + [True] * len(m))], ["s", "n", "size", "top"])

        return lean(run)

    shared = [spark.sparkContext.broadcast(m) for m in judge]
    seen = [h.where("toxic = 0").select("text").mapInArrow(clean_scores(m), "s double, n long, size long, top boolean") for h, m in zip(halves, shared, strict=True)]
    hist = seen[0].unionByName(seen[1]).groupBy("s", "top").agg(F.sum("n").alias("n"), F.sum("size").alias("size")).toPandas()
    seg, tok = hist[hist["top"]], hist[~hist["top"]]
    lam = _lambda(tok["s"].to_numpy(), tok["n"].to_numpy(float))
    k = tail_factor(seg["s"].to_numpy(), seg["n"].to_numpy(float), seg["size"].to_numpy(float), lam)
    for m in (model, *judge):
        m.lam, m.k = lam, k
    few = F.pmod(F.xxhash64("id"), F.lit(max(1, -(-int(n0 + n1) // FIT_ROWS)))) == 0
    shown = [h.where(few).select(F.col("toxic").alias("id"), F.lit(False).alias("held_out"), "text").mapInArrow(_score(spark.sparkContext.broadcast(m)), f"id int, held_out boolean, score double, best double, total double, spans {SPAN}") for h, m in zip(halves, judge, strict=True)]
    got = shown[0].unionByName(shown[1]).select("id", "best", "total").toPandas()
    model.curve = _logistic(got[["best", "total"]].to_numpy(float), got["id"].to_numpy(float))
    return model


def _weighted(counts: DataFrame, n0: int, n1: int) -> Scorer:
    """Weights from counts (f, clean, toxic) of n0 clean and n1 toxic texts, in a file; not calibrated yet."""
    prior = F.lit(ALPHA) * (F.col("clean") + F.col("toxic")) / (n0 + n1 + 1)  # under ALPHA even for what stands in every text
    odds = lambda y, n: F.log((y + prior) / (n + ALPHA - y - prior))
    weight = odds(F.col("toxic"), n1) - odds(F.col("clean"), n0) - Z * F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    best = counts.where(f"f != 0 and toxic >= {MIN_DOCS}").withColumn("weight", weight).where(F.col("weight") > DRIFT).select("f", "weight").toArrow()
    f = best["f"].to_numpy().view(np.uint64)
    order = np.argsort(f)
    return Scorer(ship(counts.sparkSession, [f[order].tobytes(), best["weight"].to_numpy()[order].tobytes()]) if len(f) else None, 1.0, 1.0, (0.0, 0.0, 0.0))


def tail_factor(top: np.ndarray, texts: np.ndarray, words: np.ndarray, lam: float) -> float:
    """The likeliest K of P(max <= x) = exp(-K n exp(-lam x)), of so many texts with so many words in all for each maximum; a maximum of 0 is one below the least positive one. Half a hit is added."""
    hit = top > 0
    least = top[hit].min() if hit.any() else 0.0
    return float((texts[hit].sum() + 0.5) / max(1e-300, (words * np.exp(-lam * np.where(hit, top, least))).sum()))


def _lambda(s: np.ndarray, n: np.ndarray) -> float:
    """The positive root of sum(p exp(lambda s)) = 1; 1 if no score is positive or the mean isn't negative."""
    if not len(s) or s.max() <= 0:
        return 1.0
    p = n / n.sum()
    if (p * s).sum() >= 0:
        return 0.1
    low, high = 0.0, 1.0
    grown = lambda x: np.log(np.sum(np.exp(np.log(p) + x * s)))
    while grown(high) < 0 and high < 50:
        low, high = high, 2 * high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if grown(mid) < 0 else (low, mid)
    return min(high, 5.0)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5) -> DataFrame:
    """(id_col, held_out, score, spans), one row per row of docs; held_out: crc32(id as text) mod `folds` is 0, and such rows teach nothing.

    spans: significant segments in code points. Null and empty texts have no tokens and score as a text without any toxic token; very long ones are read whole. A segment whose expectation is SIGNIFICANT exactly is reported. Null labels and
    labels of unknown ids teach nothing; of several labels of one id the highest counts. Null id: not held out, never a training row.
    Repeated rows each have their row. No rows, no result rows. Further columns, whatever their names, are not read.
    """
    ready(docs.sparkSession)
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("id"), is_remainder(id_col, folds, 0).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where("toxic is not null").groupBy("id").agg(F.max("toxic").alias("toxic"))
    model = fit(base.where("not held_out").select("id", "text"), marks)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = base.mapInArrow(_score(shared), f"id {kind}, held_out boolean, score double, best double, total double, spans {SPAN}")
    return out.select(F.col("id").alias(id_col), "held_out", "score", "spans")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("spans").cast("long").alias("n_segments"))


