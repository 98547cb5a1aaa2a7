"""Sharding by extendible hashing: a directory over hash-prefix bits, in which only oversized buckets split.

Rows hash to 60 bits of md5(id). A histogram of bytes over the first `bits` bits is rolled up to every shorter prefix; a
row's shard is its shortest prefix whose rows fit the limit, so the one that fits while its parent, one bit shorter, doesn't: every prefix meets its parent's sum, three rows at most, and no prefix is joined with the rows of another. Prefixes still too large at `bits` bits go on alone with
the next bits, so that the histogram stays small and the few deep buckets cost no more than they hold. Rows with one
full hash can't be told apart by bits: they fill overflow shards of their bucket, dealt by whole rows. A row larger
than the limit has a shard to itself. All of it is expressions and hash aggregates; nothing is collected but two sums.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import ready, table, written

HASH_BITS = 60
#: Prefixes of a histogram that are sent to where rows are; more are joined by a shuffle.
MOST_PREFIXES = 1 << 18
#: Bits of the first histogram at most, and further ones of each that follows.
FIRST_BITS, NEXT_BITS = 20, 12


def _hash(col: str) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def _prefix(depth: int) -> Column:
    """The first `depth` of the 60 bits."""
    return F.shiftright(F.col("h"), HASH_BITS - depth)


def shards(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text", more_bits: int = 6) -> DataFrame:
    """(id_col, n_bytes, depth, shard, shard_bytes, shard_rows), one row per row of docs; shard is the depth bits of the prefix as text, then `+k` for overflow shard k.

    No shard holds more than `limit` bytes of UTF-8 text, but for a single larger row. Null texts have 0 bytes. A null id
    hashes like the empty text; very long texts count whole. A prefix of exactly `limit` bytes fits. Repeated rows each have their row. No rows, no result rows. Further columns, whatever
    their names, are not read.
    """
    ready(docs.sparkSession)
    rows = written(docs.select(F.col(id_col).alias("id"), F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("n_bytes"), _hash(id_col).alias("h")))
    total = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    top = min(FIRST_BITS, max(1, math.ceil(math.log2(max(1, total / limit)))) + more_bits)
    done: list[DataFrame] = []
    open_, low = rows, 0
    while True:
        fine = open_.groupBy(_prefix(top).alias("p")).agg(F.sum("n_bytes").alias("n"))
        up = fine.select("p", "n", F.explode(F.sequence(F.lit(low), F.lit(top))).alias("depth"))
        short = F.call_function("shiftright", F.col("p"), (F.lit(top) - F.col("depth")).cast("int"))
        sums = up.groupBy("depth", short.alias("q")).agg(F.sum("n").alias("n"))
        family = sums.select("depth", "q", F.col("n").alias("own"), F.lit(None).cast("struct<q:long,n:long>").alias("child")).unionByName(
            sums.where(F.col("depth") > low).select((F.col("depth") - 1).alias("depth"), F.shiftright("q", 1).alias("q"), F.lit(None).cast("long").alias("own"), F.struct("q", "n").alias("child"))
        )
        split = family.groupBy("depth", "q").agg(F.max("own").alias("own"), F.collect_list("child").alias("child")).where(F.col("own") > limit)  # two children at most
        fits = split.select((F.col("depth") + 1).alias("depth"), F.explode("child").alias("c")).select("depth", F.col("c.q").alias("q"), F.col("c.n").alias("n"))
        fits = fits.unionByName(sums.where(F.col("depth") == low)).where(F.col("n") <= limit).select("depth", "q")
        wide = (F.lit(top) - F.col("depth")).cast("int")
        first = F.call_function("shiftleft", F.col("q"), wide)
        of = fits.select("depth", F.explode(F.sequence(first, first + F.call_function("shiftleft", F.lit(1).cast("long"), wide) - 1)).alias("p"))
        of = F.broadcast(of) if top <= math.log2(MOST_PREFIXES) else of
        placed = open_.withColumn("p", _prefix(top)).join(of, "p", "left").drop("p")
        if top == HASH_BITS:
            done.append(placed)
            break
        placed = written(placed)
        done.append(placed.where("depth is not null"))
        open_, low = placed.where("depth is null").drop("depth"), top + 1
        if open_.isEmpty():
            break
        top = min(HASH_BITS, top + NEXT_BITS)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    bits = F.lpad(F.bin(F.call_function("shiftright", F.col("h"), (F.lit(HASH_BITS) - F.col("depth")).cast("int"))), F.col("depth"), F.lit("0"))
    told = out.where("depth is not null").select("id", "n_bytes", "depth", F.when(F.col("depth") == 0, F.lit("")).otherwise(bits).alias("shard"))
    if top == HASH_BITS:
        told = told.unionByName(_overflow(out.where("depth is null"), limit))
    told = written(told)
    sizes = told.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_rows"))
    return told.join(sizes, "shard").select(F.col("id").alias(id_col), "n_bytes", F.col("depth").cast("int").alias("depth"), "shard", "shard_bytes", "shard_rows")


def _overflow(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of equal hash: each of those over half the limit has a shard of its own, the others share by count: as many to a shard as fit at the largest size."""
    at = written(rows.withColumn("k", F.monotonically_increasing_id()))
    big = at.where(2 * F.col("n_bytes") > limit)
    small = at.where(2 * F.col("n_bytes") <= limit)
    # copies of one row are numbered by partition counts and a window inside (hash, partition), so no group meets in one task
    small = small.withColumn("part", F.shiftright("k", 33))
    sums = small.groupBy("h", "part").agg(F.sum("n_bytes").alias("n"))
    before = F.sum("n").over(Window.partitionBy("h").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    start = sums.select("h", "part", F.coalesce(before, F.lit(0)).alias("start"))
    inside = F.sum("n_bytes").over(Window.partitionBy("h", "part").orderBy("k").rowsBetween(Window.unboundedPreceding, -1))
    half = F.lit(max(1, limit // 2))
    dealt = small.join(start, ["h", "part"]).withColumn("slot", F.floor((F.col("start") + F.coalesce(inside, F.lit(0))) / half))
    name = F.lpad(F.bin("h"), HASH_BITS, "0")
    return dealt.select("id", "n_bytes", F.lit(HASH_BITS).alias("depth"), F.concat(name, F.lit("+s"), F.col("slot")).alias("shard")).unionByName(
        big.select("id", "n_bytes", F.lit(HASH_BITS).alias("depth"), F.concat(name, F.lit("+b"), F.col("k")).alias("shard"))
    )


def directory(placed: DataFrame) -> DataFrame:
    """The directory of shards(): one row a shard with its depth, bytes, rows and the hashes [low, high) of 60 bits that its prefix covers. Overflow shards of one hash share its range."""
    bits = F.conv(F.substring_index("shard", "+", 1), 2, 10).cast("long")
    low = F.call_function("shiftleft", F.coalesce(bits, F.lit(0).cast("long")), (F.lit(HASH_BITS) - F.col("depth")).cast("int"))
    return placed.groupBy("shard", "depth").agg(F.first("shard_bytes").alias("shard_bytes"), F.first("shard_rows").alias("shard_rows")).select(
        "shard", "depth", "shard_bytes", "shard_rows", low.alias("low"), (low + F.call_function("shiftleft", F.lit(1).cast("long"), (F.lit(HASH_BITS) - F.col("depth")).cast("int"))).alias("high")
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Whole rows of docs, one folder and one file per shard: a shard is bounded, so all its rows go to one task. Ids are unique here."""
    docs.join(placed.select(id_col, "shard"), id_col).repartition("shard").write.partitionBy("shard").parquet(path)


LIMIT = 1 << 20


def op7_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir, "documents"), LIMIT)


SQL = f"""
WITH r AS (SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h FROM documents),
u AS (SELECT doc_id, n_bytes, h, unnest(range(0, 25)) AS depth FROM r),
b AS (SELECT depth, h >> (60 - depth) AS q, sum(n_bytes) AS n, count(*) AS c FROM u GROUP BY 1, 2),
f AS (SELECT u.doc_id, u.n_bytes, u.depth, b.q, b.n, b.c, row_number() OVER (PARTITION BY u.doc_id ORDER BY u.depth) AS k
  FROM u JOIN b ON b.depth = u.depth AND b.q = u.h >> (60 - u.depth) WHERE b.n <= {LIMIT})
SELECT doc_id, n_bytes, CAST(depth AS INTEGER) AS depth, CASE WHEN depth = 0 THEN '' ELSE right(lpad(bin(q), 64, '0'), CAST(depth AS INTEGER)) END AS shard,
  CAST(n AS BIGINT) AS shard_bytes, c AS shard_rows
FROM f WHERE k = 1
"""
