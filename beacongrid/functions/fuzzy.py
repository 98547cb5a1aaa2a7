"""Similarities and parsers that no built-in expression says: Arrow functions."""

from __future__ import annotations

import difflib
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructType

from .names import core_name, fuzzy_confidence, name_words, overlap, word_runs, word_trigrams


@F.pandas_udf(DoubleType())
def matcher_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratio of matching blocks of two texts, as difflib defines it, its junk rule from 200 characters on included; 0 if one is empty."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a, b, strict=True)])


def first_object(text: str | None) -> str | None:
    """The first JSON object in a text, fences and trailing commas forgiven; null if there is none that parses."""
    if not text:
        return None
    start = text.find("{")
    plain = json.JSONDecoder()
    while start >= 0:
        for s in (text[start:], re.sub(r",\s*([}\]])", r"\1", text[start:])):
            try:
                got, _ = plain.raw_decode(s)
            except ValueError:
                continue
            return json.dumps(got, sort_keys=True, separators=(",", ":"))
        start = text.find("{", start + 1)
    return None


def all_objects(text: str | None) -> list[str]:
    """Every JSON object of a damaged batch that parses by itself."""
    out, at = [], 0
    plain = json.JSONDecoder()
    text = text or ""
    while (at := text.find("{", at)) >= 0:
        try:
            got, n = plain.raw_decode(text[at:])
        except ValueError:
            at += 1
            continue
        out.append(json.dumps(got, sort_keys=True, separators=(",", ":")))
        at += n
    return out


@F.pandas_udf(StringType())
def repaired_json(text: pd.Series) -> pd.Series:
    return text.map(first_object)


@F.pandas_udf(ArrayType(StringType()))
def salvaged_json(text: pd.Series) -> pd.Series:
    return text.map(all_objects)


def resolve(df: DataFrame, id_col: str, name: str, anchors: DataFrame, least: float = 0.5, rival: float = 0.9, longest: int = 200) -> DataFrame:
    """(id, code, how, similarity, confidence) of names against anchors (code, canonical_name, aliases): by code, by alias in any case, else by the likeness of whole words.

    A likeness is strict_word_similarity of names without the words that most have; only codes of three letters take part. It needs `least`, and the runner-up at most `rival` of it, else the name is ambiguous and
    resolves to nothing. Names that are nothing but common words, null, empty or over `longest` characters resolve to nothing. Confidence: 1 by code, 0.8 by alias, 0.50 to 0.60 by likeness.
    Distinct names meet anchors by their rarest trigrams only, as many as a likeness of least * rival needs, then are compared whole.
    """
    n = df.where(F.col(name).isNotNull() & (F.length(name) <= longest)).select(id_col, F.lower(F.trim(name)).alias("q"))
    asked = n.select("q").where("q != ''").distinct()
    code = asked.join(anchors.select(F.lower("code").alias("q"), "code"), "q").select("q", "code", F.lit("code").alias("how"), F.lit(1.0).alias("similarity"), F.lit(0).alias("r"))
    alias = asked.join(anchors.select(F.explode(F.transform(F.array_union(F.array("canonical_name"), "aliases"), lambda a: F.lower(a))).alias("q"), "code"), "q").select("q", "code", F.lit("alias").alias("how"), F.lit(1.0).alias("similarity"), F.lit(1).alias("r"))
    runs = anchors.where(F.col("code").rlike("^[A-Z]{3}$")).select("code", F.explode(word_runs(name_words(core_name(F.col("canonical_name"))))).alias("w")).select("code", word_trigrams(F.col("w")).alias("y")).distinct()
    often = runs.select(F.explode("y").alias("g")).groupBy("g").agg(F.count("*").alias("c"))
    x = asked.select("q", word_trigrams(name_words(core_name(F.col("q")))).alias("x")).where(F.size("x") > 0)
    ranked = x.select("q", "x", F.explode("x").alias("g")).join(often, "g", "left").groupBy("q", "x").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "g"))).alias("by"))
    need = F.size("x") - F.ceil(F.size("x") * least * rival) + 1
    keys = ranked.select("q", "x", F.explode(F.slice("by", F.lit(1), need.cast("int"))).alias("k")).select("q", "x", F.col("k.g").alias("g"))
    alike = F.least(F.size("x"), F.size("y")) >= F.greatest(F.size("x"), F.size("y")) * (least * rival)
    near = keys.join(runs.select("code", "y", F.explode("y").alias("g")), "g").where(alike).select("q", "code", overlap(F.col("x"), F.col("y")).alias("s"))
    sim = near.groupBy("q", "code").agg(F.max("s").alias("similarity")).where(F.col("similarity") >= least * rival)
    top = sim.groupBy("q").agg(F.max(F.struct("similarity", "code")).alias("a"), F.count("*").alias("n"), F.array_sort(F.collect_list("similarity")).alias("all"))
    second = F.when(F.col("n") > 1, F.element_at("all", -2)).otherwise(0.0)
    clear = (F.col("a.similarity") >= least) & (second / F.col("a.similarity") <= rival)
    fuzzy = top.where(clear).select("q", F.col("a.code").alias("code"), F.lit("fuzzy").alias("how"), F.col("a.similarity").alias("similarity"), F.lit(2).alias("r"))
    best = code.unionByName(alias).unionByName(fuzzy).groupBy("q").agg(F.min(F.struct("r", "code", "how", "similarity")).alias("b"))
    sure = F.when(F.col("b.r") == 0, 1.0).when(F.col("b.r") == 1, 0.8).otherwise(fuzzy_confidence(F.col("b.similarity"), least))
    return n.join(best, "q").select(id_col, "b.code", "b.how", "b.similarity", sure.alias("confidence"))


def classified(df: DataFrame, text: str, model, schema: str, size: int = 4) -> DataFrame:
    """Rows with a model's verdict in `size`-row calls. model: list of texts -> list of dicts; a failed call gives nulls for its rows."""
    fields = [f.split()[0] for f in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got: list[dict] = []
            for i in range(0, len(pdf), size):
                part = pdf[text].iloc[i : i + size].tolist()
                try:
                    told = model(part)
                except Exception:  # noqa: BLE001  a model may fail in any way; the rows stay, undecided
                    told = [{}] * len(part)
                got += told if len(told) == len(part) else [{}] * len(part)
            yield pdf.assign(**{k: [g.get(k) for g in got] for k in fields})

    return df.mapInPandas(run, StructType(df.schema.fields + StructType.fromDDL(schema).fields))
