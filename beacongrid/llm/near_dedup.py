"""Near-duplicate grouping by SuperMinHash (Ertl 2017): signatures, banding, verification, union-find.

1.  One pass over the texts gives each document its number of distinct shingles, a 128-bit digest of the shingle set, a
    SuperMinHash signature and its band keys. In SuperMinHash every element draws its ranks without replacement, so an
    element's ranks are correlated across lanes and the estimate has less variance; a document stops at the first step
    after which no lane is empty, since later ranks are all larger.
2.  Documents with equal sets are one class, stood for by the smallest doc_id. Only representatives go on.
3.  Band buckets: the member whose buckets are the fullest (the most central one) leads its bucket; each member is
    compared with the leader alone, by signature, then on full sets. So a group of n copies makes n pairs, not n * n.
4.  Links found so far give components. A bucket that still holds several components has its minority members compared
    with all members of other components, in blocks of about 2 * `block` members: first as signatures, which names the rows
    that may be linked, then those rows' full sets as products of incidence matrices, in parts of 2 * MOST_SET hashes or so, whatever the length of texts. A part returns a forest over its
    components, so a group of n copies never makes n * n rows, and no link between two components is lost, whatever the size of a bucket.
    A pair is looked at in the first bucket it shares only. n members of a bucket that stay apart cost n * n / block signatures.
5.  Links and forests give the final components.

Tables of at most MOST_IDS rows (ids of copies, of pairs to compare, of shared buckets) are sent to where rows are, so that signatures aren't shuffled for them. Beyond that joins shuffle, and
buckets of more than a 4096th of all keys still meet their members by broadcast. A signature keeps 8 bits of each lane, which raises the share of equal lanes by a 256th of the unequal ones.

There are as many bands as a pair at the threshold needs to share one but for a probability of 2e-8 (24 of four lanes at 0.85, 34 at 0.8; under 0.71 bands have fewer lanes, so that there are enough of them). A pair is given up by signature where it
lies five standard deviations of the estimate below the threshold (a probability under 1e-5). Sets are compared as sets of 64-bit shingle hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ._common import HOT, MOST_IDS, Scratch, as_bytes, lean, ready, slices, small, table, written
from ._words import Words, mix, windows
from .components import components

LANES, ROWS, MISS = 256, 4, 2.1e-8
#: Hashes (8 bytes each) of the sets that a side of a block brings to a task, but for its last set.
MOST_SET = 1 << 19
_FREE = np.uint64((1 << 64) - 1)
_STEP = 0x9E3779B97F4A7C15


def _draw(x: np.ndarray, j: int) -> np.ndarray:
    return mix(x + np.uint64((j + 1) * _STEP & (1 << 64) - 1))


def superminhash(x: np.ndarray, ptr: np.ndarray, lanes: int = LANES, part: int = 30_000) -> np.ndarray:
    """Signatures (sets, lanes) of the sets x[ptr[i]:ptr[i+1]]; the high half of a lane is the step, the low half the draw. All lanes of an empty set are free."""
    sets = len(ptr) - 1
    out = np.full(sets * lanes, _FREE, np.uint64)
    count = np.diff(ptr)
    u = _draw(x, 0)
    k = ((u & np.uint64(0xFFFFFFFF)) * np.uint64(lanes) >> np.uint64(32)).astype(np.int64)
    np.minimum.at(out, np.repeat(np.arange(sets) * lanes, count) + k, u >> np.uint64(32))
    open_ = (out.reshape(sets, lanes) == _FREE).any(1) & (count > 0)
    for few in (True, False):  # small sets take many steps, so they go together
        left = np.flatnonzero(open_ & ((count < 64) == few))
        while len(left):
            n = max(1, int(np.searchsorted(np.cumsum(count[left]), part, "right")))
            now, left = left[:n], left[n:]
            _later_steps(x, k, ptr, now, out, lanes)
    return out.reshape(sets, lanes)


def _later_steps(x, first, ptr, sets, out, lanes) -> None:
    at = np.concatenate([np.arange(ptr[i], ptr[i + 1]) for i in sets])
    base = np.repeat(sets * lanes, ptr[sets + 1] - ptr[sets])
    x, rows = x[at], np.arange(len(at))
    perm = np.tile(np.arange(lanes, dtype=np.uint16 if lanes > 256 else np.uint8), (len(at), 1))
    perm[rows, first[at]] = 0  # what step 0 swapped in; place 0 isn't visited again
    for j in range(1, lanes):
        u = _draw(x, j)
        k = ((u & np.uint64(0xFFFFFFFF)) * np.uint64(lanes - j) >> np.uint64(32)).astype(np.int64) + j
        lane = perm[rows, k].astype(np.int64)
        perm[rows, k] = perm[:, j]
        np.minimum.at(out, base + lane, (u >> np.uint64(32)) | np.uint64(j << 32))
        full = ~(out.reshape(-1, lanes)[sets] == _FREE).any(1)
        if full.all():
            return
        if full.mean() > 0.3:
            keep = np.isin(base, sets[~full] * lanes)
            x, base, perm, sets = x[keep], base[keep], perm[keep], sets[~full]
            rows = np.arange(len(x))


def shingle_sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct n-word shingles of each text, sorted, and where each text's begin. Fewer words than n make one shingle; none make none."""
    w = Words(texts)
    sets = []
    for a, b in zip(w.ptr[:-1], w.ptr[1:], strict=True):
        if b - a >= n:
            sets.append(np.unique(windows(w.hash[a:b], n)))
        else:
            sets.append(windows(w.hash[a:b], int(b - a)) if b > a else w.hash[:0])
    ptr = np.zeros(len(sets) + 1, np.int64)
    np.cumsum([len(s) for s in sets], out=ptr[1:])
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), ptr


def _sums(x: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    run = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x, out=run[1:])
    return run[ptr[1:]] - run[ptr[:-1]]


def rows_for(percent: int) -> int:
    """Lanes a band: ROWS, or as many fewer as it takes to have the lanes for all bands that a low threshold needs."""
    for rows in range(ROWS, 0, -1):
        if _needed(percent, rows) <= LANES // rows:
            return rows
    raise ValueError(f"links of {percent} percent need more than {LANES} bands of one lane")


def _needed(percent: int, rows: int) -> int:
    return max(1, math.ceil(math.log(MISS) / math.log1p(-min(0.999, (percent / 100) ** rows))))


def bands_for(percent: int) -> int:
    """Bands of rows_for(percent) lanes, such that a pair at the threshold shares none with probability MISS at most."""
    return _needed(percent, rows_for(percent))


def _sign(n: int, bands: int, rows: int = ROWS):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", 1 << 20):
                x, ptr = shingle_sets(as_bytes(b.column("text")), n)
                size = np.diff(ptr)
                sig = superminhash(x, ptr)
                key = np.zeros((len(size), bands), np.uint64)
                for r in range(rows):
                    key = mix(key * np.uint64(3) + sig[:, r : bands * rows : rows])
                key = mix(key + np.arange(bands, dtype=np.uint64)[None, :])
                low = (sig & np.uint64(0xFF)).astype(np.uint8)
                some = size > 0
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32), key[some].view(np.int64).ravel())
                cols = {
                    "id": b.column("id"), "size": pa.array(size, pa.int64()), "d1": pa.array(_sums(mix(x), ptr).view(np.int64), mask=~some), "d2": pa.array(_sums(mix(x ^ np.uint64(_STEP)), ptr).view(np.int64), mask=~some),
                    "bands": lists, "sig": pa.array([s.tobytes() for s in low], pa.binary()),
                }
                yield pa.RecordBatch.from_pydict(cols)

    return lean(run)


def _set_rows(n: int, named):
    """Sets of the rows whose slot is set in the bitmap `named`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for every in batches:
            slot = every.column("slot").to_numpy()
            whole = every.filter(pa.array((named.value[slot >> 6] >> (slot & 63).astype(np.uint64) & np.uint64(1)).astype(bool)))
            for b in slices(whole, "text", 1 << 20):
                x, ptr = shingle_sets(as_bytes(b.column("text")), n)
                rows = [x[i:j].tobytes() for i, j in zip(ptr[:-1], ptr[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(rows, pa.binary())], ["id", "shingles"])

    return lean(run)


def _sets_of(base: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """Sets of the documents in `ids`, and of few others. Texts aren't shuffled: a bitmap is built by an aggregate and sent to where they are read. It has 32 to 64 slots
    for each id, up to 64 MB in all (then more of the others come along). The join that follows drops the others."""
    ids = ids.distinct()
    slots = 1 << min(29, max(16, 6 + ids.count().bit_length() - 1))
    slot = lambda: F.pmod(F.xxhash64("id"), F.lit(slots))
    word, bit = F.shiftright("slot", 6), F.expr("shiftleft(1L, cast(slot & 63 as int))")
    got = ids.select(slot().alias("slot")).groupBy(word.alias("w")).agg(F.bit_or(bit).alias("bits")).toArrow()
    named = np.zeros(slots // 64, np.uint64)
    named[got["w"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    shared = base.sparkSession.sparkContext.broadcast(named)
    return base.where("id is not null").withColumn("slot", slot()).mapInArrow(_set_rows(shingle, shared), "id long, shingles binary")


def _like(least: float):
    """Pairs whose signatures agree in a share of `least` lanes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                a, c = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint8).reshape(b.num_rows, -1) for k in ("sig_a", "sig_b"))
                good = pa.array((a == c).mean(1) >= least)
                yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(good)

    return lean(run)


def _linked(percent: int):
    """Pairs with 100 * intersection >= percent * union on full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = []
            for s, t in zip(b.column("set_a").to_pylist(), b.column("set_b").to_pylist(), strict=True):
                s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                good.append(both > 0 and 100 * both >= percent * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return lean(run)


def _dealt(left: pd.DataFrame, right: pd.DataFrame, most: int) -> pd.DataFrame:
    """A block's rows in parts (s, t) whose sides have sets of `most` hashes in all, but for the last one: each row of the left meets each of the right in one part."""
    s, t = (np.cumsum(x["size"].to_numpy()) // most for x in (left, right))
    s, t = (np.unique(x, return_inverse=True)[1] for x in (s, t))
    m, n = int(s.max(initial=-1)) + 1, int(t.max(initial=-1)) + 1
    at, to = np.repeat(np.arange(len(left)), n), np.repeat(np.arange(len(right)), m)
    return pd.concat([
        left.iloc[at].assign(s=s[at], t=np.tile(np.arange(n), len(left))),
        right.iloc[to].assign(s=np.tile(np.arange(m), len(right)), t=t[to]),
    ])


def _involved(least: float, percent: int, most: int):
    """Rows of a block that may be linked across components and share no earlier band: minority members against the others, by set size and signature. Long sets are dealt to several parts of the block."""
    drop = ["size", "sig", "bands", "band"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["odd"]], pdf[~pdf["odd"]]
        if not len(left) or not len(right):
            return _dealt(left[:0], right[:0], most).drop(columns=drop)
        s, t = (np.frombuffer(b"".join(x["sig"]), np.uint8).reshape(len(x), -1) for x in (left, right))
        u, v = (np.stack(x["bands"].tolist())[:, : pdf["band"].iloc[0]] for x in (left, right))
        m, n = left["size"].to_numpy()[:, None], right["size"].to_numpy()[None, :]
        may = (left["label"].to_numpy()[:, None] != right["label"].to_numpy()[None, :]) & (100 * np.minimum(m, n) >= percent * np.maximum(m, n))
        a, b = np.nonzero(may)
        on = [np.zeros(len(left), bool), np.zeros(len(right), bool)]
        for i in range(0, len(a), 1 << 12):
            p, q = a[i : i + (1 << 12)], b[i : i + (1 << 12)]
            new = ~(u[p] == v[q]).any(1)
            p, q = p[new], q[new]
            good = (s[p] == t[q]).mean(1) >= least
            on[0][p[good]] = True
            on[1][q[good]] = True
        return _dealt(left[on[0]], right[on[1]], most).drop(columns=drop)

    return run


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, as a product of incidence matrices over the elements both sides have, in pieces."""
    x, y = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(x, y)
    out = np.zeros((len(left), len(right)), np.float32)
    row, col = np.repeat(np.arange(len(left)), [len(v) for v in left]), np.repeat(np.arange(len(right)), [len(v) for v in right])
    for i in range(0, len(both), 1 << 12):
        part = both[i : i + (1 << 12)]
        sides = []
        for values, owner, n in ((x, row, len(left)), (y, col, len(right))):
            at = np.minimum(np.searchsorted(part, values), len(part) - 1)
            hit = part[at] == values
            dense = np.zeros((n, len(part)), np.float32)
            dense[owner[hit], at[hit]] = 1
            sides.append(dense)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def _joined(percent: int):
    """A forest of exact links between the components of a block's rows: at most one row less than it has components."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["odd"]], pdf[~pdf["odd"]]
        found: list[tuple[int, int]] = []
        if len(left) and len(right):
            p, q = ([np.frombuffer(v, np.uint64) for v in x["shingles"]] for x in (left, right))
            m, n = np.array([len(v) for v in p])[:, None], np.array([len(v) for v in q])[None, :]
            both = intersections(p, q)
            la, lb = left["label"].to_numpy(), right["label"].to_numpy()
            good = (both > 0) & (100 * both >= percent * (m + n - both)) & (la[:, None] != lb[None, :])
            parent: dict[int, int] = {}

            def find(x: int) -> int:
                while (up := parent.setdefault(x, x)) != x:
                    parent[x] = x = parent[up]
                return x

            for i, j in zip(*np.nonzero(good), strict=True):
                a, b = find(int(la[i])), find(int(lb[j]))
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    found.append((int(la[i]), int(lb[j])))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return run


def _meet(rows: DataFrame, by: DataFrame, hot: list[int]) -> DataFrame:
    """rows and by, a written table of one row a bucket, joined on k. If by is large, the buckets in `hot` still aren't shuffled."""
    if not hot or by.count() <= MOST_IDS:
        return rows.join(small(by), "k")
    keys = F.broadcast(rows.sparkSession.createDataFrame([(k,) for k in hot], "k long"))
    return rows.join(keys, "k", "left_semi").join(F.broadcast(by.join(keys, "k", "left_semi")), "k").unionByName(rows.join(keys, "k", "left_anti").join(by, "k"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, least: float | None = None, block: int = 256) -> DataFrame:
    """Near-duplicate groups: (id_col, n_shingles, component_id, kept), one row per row of docs. Ids are whole numbers.

    Texts are lower-cased (A-Z); words are runs of anything but space and 0x09-0x0D. Documents whose sets of distinct
    `shingle`-word shingles have a Jaccard similarity of `percent` / 100 or more, a tie included, are linked; thresholds of under 7 percent are an error, as there are too few lanes. least: share of equal lanes from which a pair is compared on full sets.

    Null and empty texts, and texts without words: n_shingles 0, a group of their own. Null id: component_id null, kept
    true, linked with nothing. Repeated rows of one id are one document. Fewer words than `shingle`: the whole sequence
    is one shingle. Very long texts are read whole. No rows, no result rows. Further columns of docs, whatever their names, are not read.
    """
    spark = ready(docs.sparkSession)
    if not isinstance(docs.select(id_col).schema[0].dataType, IntegralType):
        raise TypeError(f"{id_col} must hold whole numbers")
    share = percent / 100
    least = share - 5 * math.sqrt(share * (1 - share) / LANES) if least is None else least
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    one = written(base.mapInArrow(_sign(shingle, bands_for(percent), rows_for(percent)), "id long, size long, d1 long, d2 long, bands array<long>, sig binary"))
    known = one.where("id is not null and d1 is not null")
    classes = written(known.groupBy("d1", "d2", "size").agg(F.min("id").alias("rep"), F.count("*").alias("n")))
    with Scratch(spark) as scratch:
        several = small(scratch.written(classes.where("n > 1").drop("n")))
        copies = known.select("id", "d1", "d2", "size").join(several, ["d1", "d2", "size"]).where("id != rep").select("id").distinct()
        copies = scratch.written(copies.join(classes.select(F.col("rep").alias("id")), "id", "left_anti"))  # an id of several texts may stand for another class
        reps = known.join(small(copies), "id", "left_anti")
        whole = written(_groups(base, reps, scratch, shingle, percent, least, block))

    of_class = classes.join(whole.withColumnRenamed("node", "rep"), "rep", "left").select("d1", "d2", "size", F.coalesce("label", "rep").alias("group"))
    own = known.select("id", "d1", "d2", "size").join(of_class, ["d1", "d2", "size"]).groupBy("id").agg(F.min("group").alias("group"))
    got = one.select("id", "size").join(own, "id", "left")
    group = F.coalesce("group", "id")
    return got.select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"), group.alias("component_id"), F.coalesce(F.col("id") == group, F.lit(True)).alias("kept")
    )


def _groups(base: DataFrame, reps: DataFrame, scratch: Scratch, shingle: int, percent: int, least: float, block: int) -> DataFrame:
    """(node, label) of the representatives that are linked with another."""
    keys = reps.select("id", F.posexplode("bands").alias("band", "k"))
    full = scratch.written(keys.groupBy("k").agg(F.count("*").alias("n")).where("n > 1"))
    hot = [r["k"] for r in full.where(F.col("n") > max(1000, reps.count() * bands_for(percent) // HOT)).select("k").collect()]
    members = scratch.written(_meet(keys, full, hot))
    central = members.groupBy("id").agg(F.sum("n").alias("c"))
    lead = members.join(central, "id").groupBy("k").agg(F.max(F.struct("c", (-F.col("id")).alias("m"))).alias("x")).select("k", (-F.col("x.m")).alias("lead"))
    star = scratch.written(_meet(members, scratch.written(lead), hot).where("id != lead").select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).distinct())

    sigs = lambda ids: reps.join(small(scratch.written(ids.distinct())), "id", "left_semi").select("id", "size", "sig", "bands")
    ends = sigs(star.select(F.col("a").alias("id")).unionByName(star.select(F.col("b").alias("id"))))
    near = (
        star.join(ends.select(F.col("id").alias("a"), F.col("size").alias("m"), F.col("sig").alias("sig_a")), "a")
        .join(ends.select(F.col("id").alias("b"), F.col("size").alias("n"), F.col("sig").alias("sig_b")), "b")
        .where(100 * F.least("m", "n") >= percent * F.greatest("m", "n"))
        .select("a", "b", "sig_a", "sig_b")
        .mapInArrow(_like(least), "a long, b long")
    )
    label = scratch.written(components(scratch.written(_verified(base, scratch.written(near), scratch, shingle, percent)), "a", "b"))

    tagged = scratch.written(members.where("n > 2").join(label.withColumnRenamed("node", "id"), "id", "left").select("k", "band", "id", "n", F.coalesce("label", "id").alias("label")))
    parts = tagged.groupBy("k", "label").agg(F.count("*").alias("c"))
    mixed = parts.groupBy("k").agg(F.count("*").alias("parts"), F.sum("c").alias("all"), F.max(F.struct("c", "label")).alias("main")).where("parts > 1")
    mixed = mixed.select("k", F.col("main.label").alias("main"), F.ceil(F.col("all") / block).cast("int").alias("nr"), F.ceil((F.col("all") - F.col("main.c")) / block).cast("int").alias("nl"))
    rows = scratch.written(_meet(tagged, scratch.written(mixed), hot))
    rows = rows.join(sigs(rows.select("id")), "id")
    spot = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cols = ["k", "band", "id", "label", "size", "sig", "bands"]
    right = rows.select(*cols, F.lit(False).alias("odd"), spot("nr").alias("i"), every("nl").alias("j"))
    left = rows.where("label != main").select(*cols, F.lit(True).alias("odd"), every("nr").alias("i"), spot("nl").alias("j"))
    blocks = scratch.written(right.unionByName(left).groupBy("k", "i", "j").applyInPandas(_involved(least, percent, MOST_SET), "k long, id long, label long, odd boolean, i int, j int, s int, t int"))
    sets = _sets_of(base, blocks.select("id"), shingle)
    more = scratch.written(blocks.join(sets, "id").groupBy("k", "i", "j", "s", "t").applyInPandas(_joined(percent), "a long, b long").distinct())
    return components(label.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more), "a", "b")


def _verified(base: DataFrame, pairs: DataFrame, scratch: Scratch, shingle: int, percent: int) -> DataFrame:
    """The pairs that are linked, by the sets of the texts they name."""
    sets = scratch.written(_sets_of(base, pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))), shingle))
    return (
        pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b")
        .mapInArrow(_linked(percent), "a long, b long")
        .distinct()
    )


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"), shingle=3, percent=85)


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM i JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
t AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT t.b, r.root FROM r JOIN t ON t.a = r.doc_id),
c AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""
