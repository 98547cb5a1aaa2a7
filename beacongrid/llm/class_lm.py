"""Language-model scoring by class-based n-grams (Brown et al. 1992) with exchange clustering.

Tokens are words and one end a text. Every word that training texts hold LEAST times or more has a class of its own, however many such words there are; all
rarer ones share that of their spelling group, one of GROUPS by their last three bytes. Classes are found in two steps, both over all training texts:

1.  The core, words of at least a CORE-th of all tokens (so CORE at most), the end and the groups are clustered into CLASSES classes by the exchange algorithm from their
    bigrams: each moves to the class that most raises the likelihood of the class bigrams, until none does.
2.  Every other word, and every group for its rare words, is exchanged once, all at a time as in the distributed algorithm of Uszkoreit and Brants (2008): the counts of the classes
    before and after it, a sparse aggregate of Spark's, say in which class the smoothed likelihood is the highest.

    P(w | v) = P(class(w) | class(v)) P(w | class(w))

Class transitions, counted once more with the classes of all words, back off to class frequencies. Emission is c(w) / N(class). In a group every known rare word
gives D of its count to the group's one unknown word, so all words of a class and its unknown ones sum to 1.

The counts and classes of words of LEAST or more are files in the shared folder, sorted by hash, written piece by piece and mapped into memory by the workers. Every
other token goes, by text and word, to a join with the counts, so nothing is cut off.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Scratch, as_bytes, is_remainder, lean, ready, ship, slices, table, written
from ._words import SPACED, Words, mix

CORE, LEAST, GROUPS, CLASSES = 2048, 5, 256, 48
UNKNOWN, BACKOFF = 0.5, 5.0
END = 0x5851F42D4C957F2D
#: Rows of a table that the driver holds at once.
PIECE = 1 << 21


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Key of every token, whose low byte is its spelling group and the rest a hash, and where each text's begin; each text ends with the end token."""
    w = Words(texts)
    buf = np.frombuffer(w.buf, np.uint8).astype(np.uint64)
    size = w.end - w.start
    tail = buf[w.end - 1] + np.uint64(1)
    for k in (2, 3):
        tail = tail * np.uint64(257) + np.where(size >= k, buf[np.maximum(w.end - k, 0)] + np.uint64(1), np.uint64(0))
    key = (w.hash & ~np.uint64(GROUPS - 1) | mix(tail) & np.uint64(GROUPS - 1)).view(np.int64)
    return np.insert(key, w.ptr[1:], END), w.ptr + np.arange(len(w.ptr))


def _group(key: np.ndarray) -> np.ndarray:
    return key & (GROUPS - 1)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their counts."""
    key, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    u, back = np.unique(key, return_inverse=True)
    return u, np.bincount(back, n, len(u)).astype(np.int64)


def _aggregated(of):
    """(key, n) rows of a task: of(texts) gives keys and counts of a slice; sixteen slices are summed before they are sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        row = lambda: pa.RecordBatch.from_arrays([pa.array(x) for x in _summed(parts)], ["key", "n"])
        for whole in batches:
            for b in slices(whole, "text"):
                parts.append(of(as_bytes(b.column("text"))))
                if len(parts) == 16:
                    yield row()
                    parts.clear()
        if parts:
            yield row()

    return lean(run)


def _count(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(tokens(texts)[0], return_counts=True)


def _previous(x: np.ndarray, ptr: np.ndarray, end: int) -> np.ndarray:
    """Of each token, the value of the token before it; that of the end before a text's first."""
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[ptr[:-1]] = end
    return out


def _find(sorted_: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Place of each value in a sorted array; -1 if it isn't there."""
    if not len(sorted_):
        return np.full(len(x), -1)
    at = np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)
    return np.where(sorted_[at] == x, at, -1)


class Column:
    """One column of a table in the order of its key, as a file that workers map into memory."""

    def __init__(self, spark: SparkSession, parts: Iterator[np.ndarray], kind: str):
        self.kind, self.name, self.held = kind, ship(spark, (p.astype(kind).tobytes() for p in parts)), None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "held": None}

    @property
    def array(self) -> np.ndarray:
        if self.held is None:
            with open(SparkFiles.get(self.name), "rb") as f:
                f.seek(0, 2)
                self.held = np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), self.kind) if f.tell() else np.zeros(0, self.kind)
        return self.held


def _pieces(df: DataFrame, key: str, value: str, rows: int) -> Iterator[np.ndarray]:
    """A column in the order of a 64-bit key, in ranges of about PIECE rows."""
    n = max(1, -(-rows // PIECE))
    for k in range(n):
        low, high = (-(1 << 63) + (i << 64) // n for i in (k, k + 1))
        got = df.where((F.col(key) >= F.lit(low)) & (F.col(key) <= F.lit(high - 1))).select(*dict.fromkeys((key, value))).toArrow()
        yield got[value].to_numpy()[np.argsort(got[key].to_numpy())]


class Lexicon:
    """Counts and classes. core: sorted hashes; items are numbered 0 the end, then the core, then groups; of: class of each item; hash, count and cls: columns of words of LEAST or more, cls once it is known."""

    def __init__(self, core: np.ndarray, of: np.ndarray | None, end_count: int, hash_: Column, count: Column, cls: Column | None = None):
        self.core, self.of, self.end_count, self.hash, self.count, self.cls = core, of, end_count, hash_, count, cls

    def items(self, key: np.ndarray) -> np.ndarray:
        at = _find(self.core, key)
        return np.where(key == END, 0, np.where(at >= 0, at + 1, len(self.core) + 1 + _group(key)))

    def look(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each token: item, class, place in the columns (-1: rarer, or the end), count (0: not known here)."""
        item, at = self.items(key), _find(self.hash.array, key)
        cls, count = self.of[item], np.where(key == END, self.end_count, 0)
        on = np.flatnonzero(at >= 0)
        count[on] = self.count.array[at[on]]
        if self.cls is not None:
            own = on[item[on] > len(self.core)]
            cls = cls.copy()
            cls[own] = self.cls.array[at[own]]
        return item, cls, at, count


def _item_bigrams(shared, m: int):
    def of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        key, ptr = tokens(texts)
        item = shared.value.items(key)
        return np.unique(_previous(item, ptr, 0) * m + item, return_counts=True)

    return _aggregated(of)


def _neighbours(shared):
    """Keys of unit * 128 + slot of all tokens that aren't of the core. unit: place in the columns, or -1 - group; slot: class before, or CLASSES + class after."""

    def of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lexicon = shared.value
        key, ptr = tokens(texts)
        item, cls, at, _ = lexicon.look(key)
        mine = np.flatnonzero(item > len(lexicon.core))
        unit = np.where(at[mine] >= 0, at[mine], -1 - _group(key[mine])) * 128
        return np.unique(np.concatenate([unit + _previous(cls, ptr, lexicon.of[0])[mine], unit + CLASSES + cls[mine + 1]]), return_counts=True)

    return _aggregated(of)


def _class_bigrams(shared):
    def of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        key, ptr = tokens(texts)
        cls = shared.value.look(key)[1]
        return np.unique(_previous(cls, ptr, shared.value.of[0]).astype(np.int64) * CLASSES + cls, return_counts=True)

    return _aggregated(of)


def exchange(pairs: np.ndarray, classes: int, rounds: int = 8) -> np.ndarray:
    """Class of each item from the matrix of item bigrams, by exchange; items without a count stay where they began."""
    n = pairs.sum(1) + pairs.sum(0)
    order = np.argsort(-n, kind="stable")
    of = np.zeros(len(n), np.int64)
    of[order] = np.arange(len(n)) % classes
    ind = np.zeros((len(n), classes))
    ind[np.arange(len(n)), of] = 1
    right, left = pairs @ ind, pairs.T @ ind  # by item: what follows and what precedes it, by class
    both = ind.T @ right
    xlogx = lambda x: np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)
    for _ in range(rounds):
        moved = 0
        for w in order[n[order] > 0]:
            c, r, l, self_ = of[w], right[w].copy(), left[w].copy(), pairs[w, w]
            r[c] -= self_
            l[c] -= self_
            base = both.copy()
            base[c] -= r
            base[:, c] -= l
            base[c, c] -= self_
            rows, cols = base.sum(1) + l, base.sum(0) + r  # as with w in any other class
            gain = xlogx(base + r).sum(1) - xlogx(base).sum(1) + xlogx(base + l[:, None]).sum(0) - xlogx(base).sum(0)
            d = np.diag(base)
            gain += xlogx(d + r + l + self_) - xlogx(d + r) - xlogx(d + l) + xlogx(d)
            gain -= xlogx(rows + r.sum() + self_) - xlogx(rows) + xlogx(cols + l.sum() + self_) - xlogx(cols)
            k = int(np.argmax(gain))
            if gain[k] <= gain[c] + 1e-9:
                continue
            moved += 1
            both = base
            both[k] += r
            both[:, k] += l
            both[k, k] += self_
            right[:, c] -= pairs[:, w]
            right[:, k] += pairs[:, w]
            left[:, c] -= pairs[w]
            left[:, k] += pairs[w]
            of[w] = k
        if not moved:
            break
    return of


def transitions(both: np.ndarray) -> np.ndarray:
    """log10 P(class | class before), backed off to class frequencies."""
    freq = (both.sum(0) + 1) / (both.sum() + len(both))
    return np.log10((both + BACKOFF * freq) / (both.sum(1, keepdims=True) + BACKOFF))


def _best_class(step: np.ndarray, mass: np.ndarray):
    """The class of the highest likelihood of each unit, by the counts of classes around it; the first of equals."""
    weight = np.concatenate([step, step.T])  # what a class makes of each slot: of a class before it, and of one after it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("slots")
            own = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            flat = lists.flatten()
            slot, n = flat.field("slot").to_numpy(), flat.field("n").to_numpy().astype(float)
            counts = np.zeros((b.num_rows, 2 * CLASSES))
            np.add.at(counts, (own, slot), n)
            score = counts @ weight - counts[:, CLASSES:].sum(1, keepdims=True) * mass
            yield pa.RecordBatch.from_arrays([b.column("unit"), pa.array(np.argmax(score, 1).astype(np.int32))], ["unit", "cls"])

    return lean(run)


class Model:
    """lexicon with all classes, log10 transitions, log10 mass of a class, D, log10 mass of each group's unknown word, N and V."""

    def __init__(self, lexicon: Lexicon, both: np.ndarray, types: np.ndarray, n: int, v: int, discount: float):
        self.lexicon, self.n, self.v, self.discount = lexicon, n, v, discount
        self.step = transitions(both)
        mass = both.sum(0).astype(float)
        mass[lexicon.of[0]] += UNKNOWN
        np.add.at(mass, lexicon.of[len(lexicon.core) + 1 :], UNKNOWN)
        self.mass = np.log10(np.maximum(mass, 1e-300))
        self.unknown = np.log10(discount * types + UNKNOWN)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for whole in batches:
            for b in slices(whole, "text"):
                h, ptr = tokens(as_bytes(b.column("text")))
                _, cls, _, count = model.lexicon.look(h)
                end = h == END
                prev = _previous(cls, ptr, model.lexicon.of[0])
                kept = np.where(end, count + UNKNOWN, count)
                here = model.step[prev, cls] - model.mass[cls] + np.where(kept > 0, np.log10(np.maximum(kept, 1e-300)), 0.0)
                base = np.log10(np.where(count > 0, count + 1, 1) / (model.n + model.v + 1))
                rare = (count == 0) & ~end
                sums = [np.add.reduceat(x, ptr[:-1]) if len(ptr) > 1 else np.zeros(0) for x in (here, base, (count > 0).astype(np.int64))]
                own = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))[rare]
                hs = h[rare]
                order = np.lexsort((hs, own))
                own, hs = own[order], hs[order]
                new = np.ones(len(hs), bool)
                new[1:] = (hs[1:] != hs[:-1]) | (own[1:] != own[:-1])
                at = np.flatnonzero(new)
                tf = np.diff(np.append(at, len(hs)))
                off = np.searchsorted(own[at], np.arange(len(ptr))).astype(np.int32)
                lists = [pa.ListArray.from_arrays(off, pa.array(x)) for x in (hs[at], tf.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), b.column("held_out"), pa.array(np.diff(ptr), pa.int64()), *map(pa.array, sums[:2]), pa.array(sums[2], pa.int64()), *lists],
                    ["id", "held_out", "n_tokens", "score", "base_score", "n_known", "h", "tf"],
                )

    return lean(run)


def fit(train: DataFrame, counts: DataFrame, scratch: Scratch, least: int, core: int) -> Model:
    """train: (text); counts: (key, n) of all its tokens, by hash."""
    spark = train.sparkSession
    told = spark.sparkContext.broadcast
    n, v, words, once, twice, ends = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), *(F.count_if(c & (F.col("key") != END)) for c in (F.col("n") >= least, F.col("n") == 1, F.col("n") == 2)), F.coalesce(F.max(F.when(F.col("key") == END, F.col("n"))), F.lit(0))
    ).first()
    discount = min(0.9, max(0.1, once / max(1, once + 2 * twice)))
    own = counts.where((F.col("n") >= least) & (F.col("key") != END))
    hash_, count = (Column(spark, _pieces(own, "key", c, words), "<i8") for c in ("key", "n"))
    top = np.sort(own.where(F.col("n") * core >= n).select("key").toArrow()["key"].to_numpy())
    m = 1 + len(top) + GROUPS

    lexicon = Lexicon(top, None, ends, hash_, count)
    got = train.mapInArrow(_item_bigrams(told(lexicon), m), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    pairs = np.zeros(m * m)
    pairs[got["key"].to_numpy()] = got["n"].to_numpy()
    pairs = pairs.reshape(m, m)
    lexicon.of = exchange(pairs, CLASSES)
    ind = np.eye(CLASSES)[lexicon.of]
    both = ind.T @ pairs @ ind
    del got, pairs

    around = train.mapInArrow(_neighbours(told(lexicon)), "key long, n long").select(F.shiftright("key", 7).alias("unit"), F.col("key").bitwiseAND(127).cast("int").alias("slot"), "n")
    around = around.groupBy("unit", "slot").agg(F.sum("n").alias("n")).groupBy("unit").agg(F.collect_list(F.struct("slot", "n")).alias("slots"))
    mass = np.log10(np.maximum(both.sum(0), 1))
    classes = scratch.written(around.mapInArrow(_best_class(transitions(both), mass), "unit long, cls int"))
    for r in classes.where("unit < 0").collect():
        lexicon.of[len(top) - r["unit"]] = r["cls"]
    lexicon.cls = Column(spark, _by_unit(classes, words), "u1")

    got = train.mapInArrow(_class_bigrams(told(lexicon)), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    both = np.zeros(CLASSES * CLASSES)
    both[got["key"].to_numpy()] = got["n"].to_numpy()
    types = np.zeros(GROUPS)
    for r in counts.where((F.col("n") < least) & (F.col("key") != END)).groupBy(F.col("key").bitwiseAND(GROUPS - 1).alias("g")).count().collect():
        types[r["g"]] = r["count"]
    return Model(lexicon, both.reshape(CLASSES, CLASSES), types, n, v, discount)


def _by_unit(classes: DataFrame, words: int) -> Iterator[np.ndarray]:
    """Class of every word in the order of the columns; those of the core, which have theirs from their item, count as 0 here."""
    for low in range(0, words, PIECE):
        out = np.zeros(min(PIECE, words - low), np.uint8)
        got = classes.where(F.col("unit").between(low, low + PIECE - 1)).toArrow()
        out[got["unit"].to_numpy() - low] = got["cls"].to_numpy()
        yield out


def class_lm(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2, least: int = LEAST, core: int = CORE) -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of docs.

    held_out: crc32(id as text) mod `folds` is `held`; all other rows teach. base_score: log10 of add-one unigrams; score: log10
    probability by the class model, whose perplexity is 10 ** (-score / n_tokens). Null and empty texts have the end token alone; very long ones are read whole. Null id:
    not held out. Repeated rows each teach and each have their row. Classes of equal likelihood: the first. No rows, no result rows; without training rows N is 0 and every word is
    unknown. Further columns, whatever their names, are not read.
    """
    spark = ready(docs.sparkSession)
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("id"), is_remainder(id_col, folds, held).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    train = base.where("not held_out").select("text")
    counts = written(train.mapInArrow(_aggregated(_count), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")))
    with Scratch(spark) as scratch:
        model = fit(train, counts, scratch, least, core)
        rows = f"id {kind}, held_out boolean, n_tokens long, score double, base_score double, n_known long, h array<long>, tf array<int>"
        scored = written(base.mapInArrow(_score(spark.sparkContext.broadcast(model)), rows).withColumn("row", F.monotonically_increasing_id()))
    rare = scored.select("row", F.explode(F.arrays_zip("h", "tf")).alias("x")).select("row", F.col("x.h").alias("h"), F.col("x.tf").alias("tf"))
    low = counts.where(F.col("n") < least).select(F.col("key").alias("h"), F.col("n").alias("c"))
    unknown = F.element_at(F.array(*(F.lit(float(x)) for x in model.unknown)), (F.col("h").bitwiseAND(GROUPS - 1) + 1).cast("int"))
    of_row = (
        rare.join(low, "h", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("tf") * F.coalesce(F.log10(F.col("c") - F.lit(model.discount)), unknown)).alias("more"),
            F.sum(F.col("tf") * F.coalesce(F.log10(F.col("c") + 1), F.lit(0.0))).alias("more_base"),
            F.sum(F.when(F.col("c").isNotNull(), F.col("tf")).otherwise(0)).alias("more_known"),
        )
    )
    got = scored.select("row", "id", "held_out", "n_tokens", "score", "base_score", "n_known").join(of_row, "row", "left")
    return got.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(int(model.n)).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"),
    )


def op8_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm(table(spark, sf_dir, "documents"))
