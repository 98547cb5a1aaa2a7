"""How the sources of a language differ in their words, by sorting and run-length scans.

1.  Each task counts (language, source, term) over slices of the documents it reads, so what is shuffled are partial runs: a term, a source, the first document, the number of documents
    and of occurrences. Rows are dealt out by (lang, term) and sorted by (lang, term, source, document) within their partition, behind a 64-bit hash of (lang, term) that spares most comparisons of texts;
    one scan adds runs of one term, keeps the terms of LEAST documents or more, and adds the partial runs of each source of those.
2.  Totals of what is kept give every group (lang, source) its probabilities, in whole billionths.
3.  A second scan over runs of (lang, term), dealt out and sorted again with the groups of a language ahead of its terms, emits partial distances of pairs of sources; adding them gives the distances.
    The terms a group uses most beyond its language come from the same rows, the first TOP of each group.

A hot term or source is a partial run for each slice of texts, not a row for each document. A scan holds the sources of one term, and for the pairs the sources of one language; a square of distances up to
CELLS cells is added up in the task, beyond that each block of terms emits its own partial distances.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import as_bytes, lean, ready, slices, small, table, written
from ._words import LETTERS, Words, mix

LEAST, TOP, UNIT, PRIOR = 30, 50, 1_000_000_000, 5
#: Bytes of texts that are counted at once, and cells of a square of distances.
SLICE, CELLS = 8 << 20, 1 << 22
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PARTIAL = pa.schema([("lang", pa.string()), ("term", pa.string()), ("source", pa.string()), ("doc", pa.int64()), ("docs", pa.int64()), ("n", pa.int64())])
_KEPT = pa.schema([("lang", pa.string()), ("term", pa.string()), ("source", pa.string()), ("n", pa.int64()), ("all_n", pa.int64()), ("head", pa.bool_())])


def _spans(buf: bytes, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Pieces of a buffer as an array of texts."""
    size = end - start
    to = np.concatenate([[0], np.cumsum(size)])
    data = np.frombuffer(buf, np.uint8)[np.arange(to[-1]) + np.repeat(start - to[:-1], size)]
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(to.astype(np.int32)), pa.py_buffer(data))


@lean
def _partial_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and occurrences of each (lang, source, term) of a slice of texts."""
    for whole in batches:
        for b in slices(whole, "text", SLICE):
            w = Words(as_bytes(b.column("text")), LETTERS)
            own = w.owner()
            if not len(own):
                continue
            of: dict[tuple[str, str], int] = {}
            group = np.array([of.setdefault(k, len(of)) for k in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), strict=True)])
            _, first, n = np.unique(mix(w.hash + own.astype(np.uint64) * _ODD), return_index=True, return_counts=True)  # a term of a document
            _, at, back = np.unique(mix(w.hash[first] ^ mix(group[own[first]].astype(np.uint64) + np.uint64(1))), return_index=True, return_inverse=True)
            place, docs, total = first[at], np.bincount(back), np.bincount(back, weights=n).astype(np.int64)
            order = np.argsort(place)  # rows of a document stay together, which packs well
            place, docs, total = place[order], docs[order], total[order]
            row = own[place]
            names = [pa.array([k[i] for k in of], pa.string()).take(pa.array(group[row])) for i in (0, 1)]
            term = _spans(w.buf, w.start[place], w.end[place])
            doc = b.column("doc").take(pa.array(row))
            yield pa.RecordBatch.from_arrays([names[0], term, names[1], doc, pa.array(docs), pa.array(total)], schema=_PARTIAL)


def _starts(b: pa.Table | pa.RecordBatch, names: list[str]) -> np.ndarray:
    """Whether each row begins a run of equal values in the named columns."""
    out = np.zeros(b.num_rows, bool)
    out[:1] = True
    for c in names:
        col = b.column(c)
        col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
        out[1:] |= pc.not_equal(col[1:], col[:-1]).to_numpy(zero_copy_only=False)
    return out


def _by_source(b: pa.Table) -> pa.Table:
    """One row for each run of a source: its documents and occurrences added."""
    at = np.flatnonzero(_starts(b, ["lang", "term", "source"]))
    if not len(at):
        return b
    sums = [pa.array(np.add.reduceat(b.column(c).to_numpy(), at)) for c in ("docs", "n")]
    return pa.table([*(b.column(c).take(pa.array(at)) for c in ("lang", "term", "source")), *sums], names=["lang", "term", "source", "docs", "n"])


def _wide(batches: Iterator[pa.RecordBatch], rows: int = 1 << 16) -> Iterator[pa.Table]:
    """The batches, some `rows` rows at once."""
    held, n = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            n += b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _scan(least: int):
    """Runs of (lang, term) with `least` documents or more: a row for each source of them."""

    def begins(t: pa.Table) -> np.ndarray:
        """Where a run of (lang, term) begins: rows of one hash are compared, all others differ."""
        h = t.column("h").to_numpy()
        out = np.append(True, h[1:] != h[:-1])
        alike = np.flatnonzero(~out)
        if len(alike):
            now, then = (t.select(["lang", "term"]).take(pa.array(i)) for i in (alike, alike - 1))
            out[alike] = np.logical_or(*(pc.not_equal(now.column(c), then.column(c)).to_numpy() for c in ("lang", "term")))
        return out

    def kept(t: pa.Table) -> pa.Table:
        at = np.flatnonzero(begins(t))
        size = np.diff(np.append(at, t.num_rows))
        enough = np.repeat(np.add.reduceat(t.column("docs").to_numpy(), at) >= least, size)
        t = _by_source(t.filter(pa.array(enough)).drop_columns("h").combine_chunks())
        head = _starts(t, ["lang", "term"])
        at = np.flatnonzero(head)
        n = t.column("n").to_numpy()
        every = np.repeat(np.add.reduceat(n, at), np.diff(np.append(at, t.num_rows))) if len(at) else n
        return pa.table([*(t.column(c) for c in ("lang", "term", "source", "n")), pa.array(every), pa.array(head)], schema=_KEPT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for now in _wide(batches):
            now = pa.concat_tables([tail, now]).combine_chunks() if tail is not None else now
            cut = int(np.flatnonzero(begins(now))[-1])
            tail = now.slice(cut).combine_chunks()
            if not cut and tail.num_rows > 1 << 16:  # one run goes on and on
                added = _by_source(tail.drop_columns("h"))
                added = added.append_column("h", pa.repeat(tail.column("h")[0], added.num_rows))
                tail = pa.table(added.select(tail.column_names).columns, schema=tail.schema)  # as the batches that follow, whose columns of Spark may be declared never null
            if cut:
                yield from kept(now.slice(0, cut)).to_batches()
        if tail is not None:
            yield from kept(tail).to_batches()

    return lean(run)


def _pairs(cells: int):
    """Partial distances of the pairs of sources of each language: rows of kind 0 name a language's sources with the probability of a term they lack, rows of kind 1 are terms."""

    def run(batches: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        lang = None
        names: list[str] = []
        rest: list[int] = []
        square = base = None
        tail = None

        def rows(lo: int, part: np.ndarray) -> pa.RecordBatch:
            """part[i] holds distances of source lo + i to all; each pair once."""
            i, j = np.nonzero(np.arange(len(names))[None, :] > np.arange(lo, lo + len(part))[:, None])
            known = pa.array(names, pa.string())
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(i), pa.string()), known.take(pa.array(i + lo)), known.take(pa.array(j)), pa.array(part[i, j])], ["lang", "a", "b", "value"])

        def begin() -> None:
            nonlocal base, square
            base = np.array(rest, np.int64)
            square = np.zeros((len(names), len(names)), np.int64) if len(names) ** 2 <= cells else None

        def add(t: pa.Table) -> Iterator[pa.RecordBatch]:
            """Whole runs of terms."""
            begins = _starts(t, ["term"])
            term, at = np.cumsum(begins) - 1, pc.index_in(t.column("source"), pa.array(names, pa.string())).to_numpy()
            p, most = t.column("p").to_numpy(), max(1, cells // len(names))
            for lo in range(0, int(term[-1]) + 1, most):
                on = slice(*np.searchsorted(term, [lo, lo + most]))
                grid = np.tile(base, (int(term[on][-1]) + 1 - lo, 1))
                grid[term[on] - lo, at[on]] = p[on]
                for i in range(len(names)):
                    row = np.abs(grid - grid[:, i : i + 1]).sum(0)
                    if square is not None:
                        square[i] += row
                    else:
                        yield rows(i, row[None, :])

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal tail
            if tail is not None:
                yield from add(tail)
                tail = None
            if lang is not None:
                yield rows(0, square if square is not None else np.zeros((len(names), len(names)), np.int64))

        for b in batches:
            t = b.select(["lang", "kind", "term", "source", "p"])
            cuts = [*np.flatnonzero(_starts(t, ["lang", "kind"])).tolist(), t.num_rows]
            for s, e in zip(cuts, cuts[1:], strict=False):
                part = t.slice(s, e - s)
                if part.column("lang")[0].as_py() != lang:
                    yield from close()
                    lang, names, rest, base = part.column("lang")[0].as_py(), [], [], None
                if part.column("kind")[0].as_py() == 0:
                    names += part.column("source").to_pylist()
                    rest += part.column("p").to_pylist()
                    begin()
                    continue
                part = (pa.concat_tables([tail, part]) if tail is not None else part).combine_chunks()
                cut = int(np.flatnonzero(_starts(part, ["term"]))[-1])
                if cut:
                    yield from add(part.slice(0, cut))
                tail = part.slice(cut)
        yield from close()

    return lean(run)


def _share(n: str, total: str, terms: str):
    """1 + floor(UNIT * (n + PRIOR) / (total + PRIOR * terms)), exactly; 1 where there are no terms."""
    return F.expr(f"1 + coalesce(cast({n} + {PRIOR} as decimal(27,0)) * cast({UNIT} as decimal(10,0)) div nullif(cast({total} + {PRIOR} * {terms} as decimal(21,0)), 0), 0L)")


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = LEAST, top: int = TOP, cells: int = CELLS) -> DataFrame:
    """(lang, source, part, item, value, rank): how each group (lang, source) differs from the others of its language.

    Terms are runs of letters and of anything beyond ASCII, A-Z lower-cased. A language keeps the V terms that stand in `least` of its documents or more. A group with n occurrences of a term and N
    of all kept terms gives it p = 1 + floor(UNIT * (n + PRIOR) / (N + PRIOR * V)); a language likewise, q. part `pair`: item is each other source of the language, value the sum of |p - p'| over the kept terms
    (0 if there are none). part `term`: item is each kept term that the group uses and with p > q, value p - q, the first `top`. rank counts from 1 in a group and part by value descending, then item
    ascending (UTF-8). All numbers are whole and exact.

    Null texts, languages and sources are ''. Every row is a document, so repeated rows count each time. Texts without terms, empty ones and very long ones are counted like others; a language of one source has no pairs. No rows, no
    result rows. Further columns, whatever their names, are not read.
    """
    spark = ready(docs.sparkSession)
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    base = docs.select(said(text_col).alias("text"), said(lang_col).alias("lang"), said(source_col).alias("source"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partial = base.withColumn("doc", F.monotonically_increasing_id()).mapInArrow(_partial_runs, "lang string, term string, source string, doc long, docs long, n long")
    in_order = partial.repartition(n, "lang", "term").withColumn("h", F.xxhash64("lang", "term")).sortWithinPartitions("h", "lang", "term", "source", "doc").drop("doc")
    kept = written(in_order.mapInArrow(_scan(least), "lang string, term string, source string, n long, all_n long, head boolean"))

    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    langs = kept.where("head").groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all_n").alias("total"))
    groups = base.groupBy("lang", "source").agg(F.count("*").alias("documents")).join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = written(groups.select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("own", "terms", "total"))))
    shares = kept.join(small(groups), ["lang", "source"]).select("lang", "source", "term", _share("n", "own", "terms").alias("p"), _share("all_n", "total", "terms").alias("q"))

    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)

    heads = groups.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("deal"), "lang", F.lit(0).alias("kind"), F.lit("").alias("term"), "source", _share("0", "own", "terms").alias("p"))
    dealt = heads.unionByName(shares.select(F.pmod(F.xxhash64("lang", "term"), F.lit(n)).cast("int").alias("deal"), "lang", F.lit(1).alias("kind"), "term", "source", "p"))
    dealt = dealt.repartition(n, "deal").sortWithinPartitions("deal", "lang", "kind", "term", "source").select("lang", "kind", "term", "source", "p", "deal")
    # a partition of two deals sees a language's sources again with the second: the sort by deal keeps them apart
    sums = dealt.mapInArrow(_dealt(_pairs(cells)), "lang string, a string, b string, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = sums.select("lang", both.alias("x"), "value").select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value").withColumn("rank", F.row_number().over(first))
    return pairs.unionByName(terms)


def _dealt(run):
    """run over the batches of each deal by itself."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ahead: list[pa.Table] = []
        pieces = (b.slice(s, e - s) for b in _wide(batches) for c in [[*np.flatnonzero(_starts(b, ["deal"])).tolist(), b.num_rows]] for s, e in zip(c, c[1:], strict=False))

        def of(deal: int) -> Iterator[pa.Table]:
            while ahead and ahead[0].column("deal")[0].as_py() == deal:
                yield ahead.pop()
                ahead.extend(b for b in [next(pieces, None)] if b is not None)

        ahead.extend(b for b in [next(pieces, None)] if b is not None)
        while ahead:
            yield from run(of(ahead[0].column("deal")[0].as_py()))

    return go


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
f AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(ws)) AS term FROM d) GROUP BY lang, term HAVING count(*) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(ws) AS term FROM d) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
m AS (SELECT g.lang, g.source, f.term, coalesce(c.n, 0) AS n FROM g JOIN f ON f.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = f.term),
p AS (SELECT lang, source, term, n, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (sum(n) OVER w + 5 * count(*) OVER w) AS p FROM m WINDOW w AS (PARTITION BY lang, source)),
l AS (SELECT lang, term, sum(n) AS n FROM m GROUP BY lang, term),
q AS (SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (sum(n) OVER w + 5 * count(*) OVER w) AS q FROM l WINDOW w AS (PARTITION BY lang)),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT u.lang, u.source AS a, v.source AS b, sum(abs(u.p - v.p)) AS value FROM p u JOIN p v ON u.lang = v.lang AND u.term = v.term AND u.source <> v.source GROUP BY 1, 2, 3) s
    ON s.lang = a.lang AND s.a = a.source AND s.b = b.source
  UNION ALL SELECT p.lang, p.source, 'term', p.term, p.p - q.q FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM x)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 50
"""
