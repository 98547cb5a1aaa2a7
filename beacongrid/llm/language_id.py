"""Language identification by hierarchical discrimination: the family first, then one-versus-one linear SVMs within it.

Features are hashed byte 1- to 4-grams of the lower-cased letters of the whole text, as square roots of their shares, so that a text of any
length is one vector of unit length. Families are found from the training languages: mean vectors are joined bottom-up by cosine while they are
nearer than the mean distance between languages. Family and language decisions are linear support vector machines (L2-regularised hinge loss,
dual coordinate descent), one for each pair; the pairs vote, ties go to the larger sum of margins.

Training uses at most TRAIN_ROWS distinct texts (one of each language at least), an equal share for each language: those with the smallest hashes, so
min(distinct texts, share) of each language, whatever copies it has. Everything else is read whole.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Scratch, as_bytes, is_remainder, lean, ready, slices, table, typed

DIM, TRAIN_ROWS, ROUNDS, COST = 1 << 12, 4_000, 12, 1.0
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True

#: Byte classes: letters stay (a-z, and all bytes from 0x80), anything else is one space.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[[*range(97, 123), *range(128, 256)]] = [*range(97, 123), *range(128, 256)]
_FOLD[65:91] = np.arange(97, 123)


def vectors(texts: list[bytes]) -> np.ndarray:
    """One row of DIM features for each text; a text without letters is all 0."""
    out = np.zeros((len(texts), DIM), np.float32)
    buf = _FOLD[np.frombuffer(b" ".join(texts) + b" ", np.uint8)].astype(np.uint64)
    own = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    flat = out.reshape(-1)
    code = np.zeros(len(buf), np.uint64)
    letter = buf != 32
    for n in range(1, 5):
        m = len(buf) - n + 1
        if m <= 0:
            break
        code = code[:m] * np.uint64(257) + buf[n - 1 :]
        h = code * np.uint64(0x9E3779B97F4A7C15 + 2 * n)
        at = own[:m] * DIM + (h >> np.uint64(52)).astype(np.int64)
        keep = letter[:m] if n == 1 else (letter[:m] | letter[n - 1 :]) & (own[:m] == own[n - 1 :])
        flat += np.bincount(at[keep], minlength=len(flat)).astype(np.float32)
    total = out.sum(1, keepdims=True)
    return np.sqrt(out / np.maximum(total, 1))


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def svm(x: np.ndarray, y: np.ndarray, rows: np.ndarray, cost: float = COST, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (bias last) of a linear SVM over x[rows] by dual coordinate descent; y is 1 or -1. Balanced: each class has the same total cost. x is never copied."""
    share = np.where(y > 0, (y < 0).sum(), (y > 0).sum()) / len(y) * 2 * cost
    alpha, w, one = np.zeros(len(y)), np.zeros(x.shape[1] + 1), np.ones(x.shape[1] + 1)
    norm = np.array([1 + float(np.square(x[i].astype(np.float32)).sum()) for i in rows])
    rng = np.random.default_rng(7)
    for _ in range(rounds):
        worst = 0.0
        for i in rng.permutation(len(y)):
            one[:-1] = x[rows[i]]
            g = y[i] * (w @ one) - 1
            new = min(max(alpha[i] - g / norm[i], 0.0), share[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * one
                worst = max(worst, abs(new - alpha[i]))
                alpha[i] = new
        if worst < 1e-3:
            break
    return w


def families(means: dict[str, np.ndarray]) -> list[list[str]]:
    """Groups of languages, joined bottom-up by the cosine distance of their mean vectors, up to the mean distance between two of them."""
    names = sorted(means)
    unit = {n: means[n] / max(1e-12, float(np.linalg.norm(means[n]))) for n in names}
    apart = {(a, b): 1 - float(unit[a] @ unit[b]) for a, b in itertools.combinations(names, 2)}
    limit = np.mean(list(apart.values())) if apart else 0.0
    groups = [[n] for n in names]
    while len(groups) > 2:
        d, i, j = min((np.mean([apart[tuple(sorted((a, b)))] for a in groups[i] for b in groups[j]]), i, j) for i in range(len(groups)) for j in range(i))
        if d > limit:
            break
        groups[j] = sorted(groups[j] + groups[i])
        del groups[i]
    return sorted(groups)


class Votes:
    """One-versus-one machines over named classes."""

    def __init__(self, x: np.ndarray, y: list[str]):
        self.names = sorted(set(y))
        y_ = np.array(y)
        self.pairs = list(itertools.combinations(range(len(self.names)), 2))
        w = []
        for a, b in self.pairs:
            of = np.flatnonzero((y_ == self.names[a]) | (y_ == self.names[b]))
            w.append(svm(x, np.where(y_[of] == self.names[a], 1.0, -1.0), of))
        self.w = np.array(w).T.astype(np.float32) if w else np.zeros((x.shape[1] + 1, 0), np.float32)

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class number and confidence (the smallest logistic margin over its rivals)."""
        m = x @ self.w[:-1] + self.w[-1]
        votes, total = np.zeros((len(x), len(self.names))), np.zeros((len(x), len(self.names)))
        sure = np.ones((len(x), len(self.names)))
        for k, (a, b) in enumerate(self.pairs):
            p = 1 / (1 + np.exp(-4 * m[:, k].astype(np.float64)))
            votes[:, a] += m[:, k] >= 0
            votes[:, b] += m[:, k] < 0
            total[:, a] += m[:, k]
            total[:, b] -= m[:, k]
            sure[:, a], sure[:, b] = np.minimum(sure[:, a], p), np.minimum(sure[:, b], 1 - p)
        best = np.argmax(votes + 1e-3 * np.tanh(total), 1)
        return best, sure[np.arange(len(x)), best]


class Identifier:
    def __init__(self, x: np.ndarray, y: list[str]):
        names = sorted(set(y))
        y_ = np.array(y)
        self.families = families({n: x[y_ == n].mean(0, dtype=np.float32) for n in names})
        of = {n: str(i) for i, g in enumerate(self.families) for n in g}
        self.top = Votes(x, [of[n] for n in y]) if names else None
        self.inner = {}
        for i, g in enumerate(self.families):
            inside = np.isin(y_, g)
            self.inner[str(i)] = Votes(x[inside], y_[inside].tolist())

    def predict(self, texts: list[bytes], letters: np.ndarray) -> tuple[list[str], np.ndarray]:
        lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        at = np.flatnonzero(letters)
        if not len(at) or self.top is None:
            return lang, score
        x = vectors([texts[i] for i in at])
        family, p = self.top.decide(x)
        for k, name in enumerate(self.top.names):
            here = np.flatnonzero(family == k)
            if len(here):
                v = self.inner[name]
                best, q = v.decide(x[here])
                for i, b in zip(at[here].tolist(), best.tolist(), strict=True):
                    lang[i] = v.names[b]
                score[at[here]] = p[here] * q
        return lang, score


def fit(train: DataFrame, most: int = TRAIN_ROWS) -> Identifier:
    """train: (text, lang). Languages are those with a text that has a letter."""
    rows = train.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).where(F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    with Scratch(ready(train.sparkSession)) as scratch:
        return _fitted(rows, scratch.written(rows.select("lang", "h").distinct()), most)


def _fitted(rows: DataFrame, keys: DataFrame, most: int) -> Identifier:
    of_lang = {r["lang"]: r["n"] for r in keys.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not of_lang:
        return Identifier(np.zeros((0, DIM), np.float16), [])
    each = max(1, most // len(of_lang))
    chosen = _smallest(keys, of_lang, each)
    picked = rows.join(F.broadcast(rows.sparkSession.createDataFrame(chosen, "lang string, h long")), ["lang", "h"]).dropDuplicates(["lang", "h"]).select("lang", "text")
    langs, xs = [], []
    for r in picked.mapInArrow(_sample, "lang string, x binary").toLocalIterator():
        langs.append(r["lang"])
        xs.append(bytes(r["x"]))
    order = sorted(range(len(langs)), key=lambda i: (langs[i], xs[i]))
    x = np.empty((len(xs), DIM), np.float16)
    for k, i in enumerate(order):
        x[k] = np.frombuffer(xs[i], np.float16)
    return Identifier(x, [langs[i] for i in order])


def _smallest(keys: DataFrame, of_lang: dict[str, int], each: int) -> list[tuple[str, int]]:
    """The min(n, each) smallest hashes of each language, of which keys: (lang, h) has of_lang[lang] = n. Reads those below a bound that most likely holds enough, then a wider one where it didn't."""
    out, left, room = [], dict(of_lang), each + 6 * each**0.5 + 16
    while left:
        most = {lang: (1 << 63) - 1 if room >= n else int(2**64 * room / n) - (1 << 63) for lang, n in left.items()}
        bound = keys.sparkSession.createDataFrame(sorted(most.items()), "lang string, most long")
        found: dict[str, list[int]] = {lang: [] for lang in left}
        for r in keys.join(F.broadcast(bound), "lang").where("h <= most").select("lang", "h").collect():
            found[r["lang"]].append(r["h"])
        for lang, h in found.items():
            if len(h) >= min(each, left[lang]):
                out += [(lang, x) for x in sorted(h)[:each]]
                del left[lang]
        room *= 4
    return out


@lean
def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for b in slices(whole, "text"):
            x = vectors(as_bytes(b.column("text"))).astype(np.float16)
            yield pa.RecordBatch.from_arrays([b.column("lang"), pa.array([v.tobytes() for v in x], pa.binary())], ["lang", "x"])


def _predict(shared, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", 1 << 20):
                for i in range(0, b.num_rows, 512):
                    part = b.slice(i, 512)
                    texts = as_bytes(part.column("text"))
                    # an ASCII letter settles it; only texts without one are decoded
                    letters = np.array([bool(_ASCII_LETTER[np.frombuffer(t[:256], np.uint8)].any()) or has_letter(t.decode("utf-8", "replace")) for t in texts], bool)
                    lang, score = shared.value.predict(texts, letters)
                    names = ["id", "held_out", "text"][: 2 + with_text]
                    yield pa.RecordBatch.from_arrays([*map(part.column, names), pa.array(lang, pa.string()), pa.array(score, pa.float64())], [*names, "lang_pred", "score"])

    return lean(run)


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, held: int = 2, row: Column | None = None) -> DataFrame:
    """(id_col, held_out, lang_pred, score), one row per row of docs; held_out: crc32(id as text) mod `folds` is `held`, and such rows teach nothing.

    `und` with score 0 for null texts, texts without a letter, and if there is nothing to learn from; very long texts are read whole. Null lang teaches nothing. Null id: not
    held out. Repeated rows each have their row; votes that tie go to the larger sum of margins, then to the first name. No rows, no result rows. Further columns, whatever their names, are not read. row, if given,
    is handed through in place of the id, and the text with it.
    """
    ready(docs.sparkSession)
    with_text = row is not None
    row = F.col(id_col) if row is None else row
    base = docs.select(row.alias("id"), is_remainder(id_col, folds, held).alias("held_out"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    model = fit(base.where("not held_out").select("text", "lang"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = base.select("id", "held_out", "text").mapInArrow(_predict(shared, with_text), typed(base.schema["id"].dataType, "held_out boolean, " + "text string, " * with_text + "lang_pred string, score double"))
    return out.withColumnRenamed("id", id_col)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))
