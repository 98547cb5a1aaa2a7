"""A training corpus from raw documents: language, near-duplicates, benchmark passages, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of docs; run() writes each
stage's rows as Parquet into the shared folder and reads them again, so a later stage never repeats an earlier one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beacongrid.llm._common import row_of, small, small_batches, table, written
from beacongrid.llm.bpe import bpe, tokenizer_path
from beacongrid.llm.decontaminate import contaminated, decontaminate
from beacongrid.llm.language_id import UNKNOWN, language_id
from beacongrid.llm.near_dedup import near_dedup
from beacongrid.llm.sanitise import sanitise


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which no language can be told go: null and empty texts and texts without a letter. A missing lang is filled in. Repeated rows, very long texts and rows without doc_id stay; no rows, no result rows."""
    small_batches(spark)
    found = language_id(docs, row=row_of(docs, ("text",))).where(F.col("lang_pred") != UNKNOWN)
    now = {"text": F.col("text"), "lang": F.coalesce("doc_id.lang", "lang_pred")}
    return found.select(*(now[c].alias(c) if c in now else F.col(f"doc_id.`{c}`").alias(c) for c in docs.columns))


def first_of(docs: DataFrame) -> DataFrame:
    """Of each doc_id the row of the smallest digest of its text, a null text's first; of equal texts, the smallest as JSON. Aggregated before rows are shuffled, whatever a doc_id's share of them."""
    row = row_of(docs)
    order = F.struct(F.sha2("text", 256), F.to_json(row))
    return docs.groupBy("doc_id").agg(F.min_by(row, order).alias("row")).select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group (five-word shingles, similarity of 0.8 or more) stays, the one of the smallest doc_id. If a doc_id is repeated, the row of the smallest digest of its text stays (a null text's before
    all others; of equal texts, the smallest as JSON). Rows without doc_id and documents without words stay; very long texts are compared whole; no rows, no result rows."""
    groups = written(near_dedup(docs, shingle=5, percent=80))
    gone = small(written(groups.where("not kept").select("doc_id").distinct()))  # else all texts would be shuffled
    again = groups.where("doc_id is not null and kept").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    left = docs.join(gone, "doc_id", "left_anti")
    if not again.isEmpty():
        left = left.join(again, "doc_id", "left_anti").unionByName(first_of(left.join(again, "doc_id", "left_semi")))
    return left.select(*(f"`{c}`" for c in docs.columns))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows make up a twentieth or more, exactly a twentieth included, go. Null and empty texts, rows without doc_id and repeated rows stay; very long texts are
    read whole; no rows, no result rows; no items, nothing goes."""
    packed = docs.select(row_of(docs, ("text",)).alias("row"), F.col("text"))
    found = decontaminate(packed, table(spark, sf_dir, "benchmark"), id_col="row", with_text=True).where(~contaminated())
    return found.select(*(F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and what discloses it is masked in the text; n_chars follows. Null texts stay null, empty ones empty; repeated rows are treated alike, very long texts whole; no rows, no result rows."""
    clean = sanitise(docs)
    now = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}
    return clean.select(*(now[c].alias(c) if c in now else F.col(f"`{c}`") for c in docs.columns))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, packed as little-endian unsigned 32-bit integers, with digests of ids and decoded text. Null and empty texts have no ids; repeated rows and rows without doc_id each have their row; very long texts are encoded whole; no rows, no result rows."""
    got = bpe(docs, tokenizer_path())
    return got.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("personal_data", personal_data),
    ("encoded", encoded),
]

#: SQL can express neither the language model nor the tokenizer; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = small_batches(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs)
    return docs
