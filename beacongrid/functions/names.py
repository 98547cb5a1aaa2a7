"""Names of places: their telling words, trigrams, and the likeness of a name to whole words of another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import BOILERPLATE


def core_name(name: Column) -> Column:
    """A name in lower case without the words that most names of airports have; '' if nothing is left."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(name), BOILERPLATE, " "), r"\s+", " "))


def name_words(name: Column) -> Column:
    """Letters and digits between anything else."""
    return F.filter(F.split(F.lower(name), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def trigrams(word: Column) -> Column:
    """Distinct three-letter pieces of a word, two blanks before and one after it."""
    padded = F.concat(F.lit("  "), word, F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, F.lit(3))))


def word_trigrams(words: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(words, trigrams)))


def word_runs(words: Column) -> Column:
    """Every run of neighbouring words."""
    n = F.size(words)
    one = lambda i: F.transform(F.sequence(i, n), lambda j: F.slice(words, i, j - i + 1))
    return F.when(n > 0, F.flatten(F.transform(F.sequence(F.lit(1), n), one))).otherwise(F.array().cast("array<array<string>>"))


def overlap(a: Column, b: Column) -> Column:
    """Shared part of two sets; 0 if both are empty."""
    both = F.size(F.array_intersect(a, b))
    return F.coalesce(both / F.nullif(F.size(a) + F.size(b) - both, F.lit(0)), F.lit(0.0))


def strict_word_similarity(query: Column, name: Column) -> Column:
    """The best overlap of the query's trigrams with those of a run of whole words of the name; 0 without words. A run counts as a set, so a repeated word adds nothing."""
    q = word_trigrams(name_words(query))
    return F.coalesce(F.array_max(F.transform(word_runs(name_words(name)), lambda r: overlap(q, word_trigrams(r)))), F.lit(0.0))


def fuzzy_confidence(similarity: Column, least: float = 0.5) -> Column:
    """Confidence of an accepted likeness: 0.50 at `least` to 0.60 at 1, so that it is never low and never high."""
    return F.round(0.50 + (similarity - least) / (1.0 - least) * 0.10 + F.lit(1e-9), 2)


def registrable_by(df: DataFrame, host: str, rules: DataFrame, rule: str = "rule") -> DataFrame:
    """(host, suffix, domain) of each distinct host: its public suffix by a table of rules, and the domain one label below it (the host itself where it is a suffix).

    Rules are those of a public suffix list: `com`, `co.uk`; `*.ck` (any one label below ck is a suffix too); `!www.ck` (it isn't one, whatever the others say). An exception prevails, then the longest match; without one the last
    label is the suffix. Comment lines (//) and empty ones are skipped. Hosts are lower-cased, dots at their ends dropped; null and empty hosts have no row. Hosts and rules meet by equality on each suffix of the host.
    """
    r = rules.select(F.lower(F.trim(rule)).alias("r")).where("r is not null and r != '' and r not like '//%'")
    r = r.select(F.regexp_replace("r", r"^(!|\*\.)", "").alias("key"), F.when(F.col("r").startswith("!"), -1).when(F.col("r").startswith("*."), 1).otherwise(0).alias("more")).distinct()
    h = df.select(F.regexp_replace(F.lower(F.trim(host)), r"^\.+|\.+$", "").alias("host")).where("host != ''").distinct().withColumn("p", F.split("host", r"\."))
    tails = h.select("host", "p", F.explode(F.sequence(F.lit(1), F.size("p"))).alias("n")).withColumn("key", F.array_join(F.slice("p", -F.col("n"), F.col("n")), "."))
    hits = tails.join(r, "key").where(F.col("n") + F.col("more") <= F.size("p")).groupBy("host").agg(F.max(F.struct((F.col("more") == -1).alias("exception"), (F.col("n") + F.col("more")).alias("labels"))).alias("m"))
    n = F.coalesce("m.labels", F.lit(1))
    told = h.join(hits, "host", "left").withColumn("n", n).withColumn("d", F.least(F.col("n") + 1, F.size("p")))
    return told.select("host", F.array_join(F.slice("p", -F.col("n"), F.col("n")), ".").alias("suffix"), F.array_join(F.slice("p", -F.col("d"), F.col("d")), ".").alias("domain"))
