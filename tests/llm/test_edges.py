"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, for every operator and stage."""

import hashlib
import itertools

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from beacongrid.llm import _common, bpe, class_lm, decontaminate, html_extract, language_id, near_dedup, quality, sanitise, sharding, toxicity

LONG = "the whole of it is long and very much so, " * 8000
ROWS = [
    (1, "the cat sat on the mat and the dog lay by the door", "en", "a", 50),
    (2, "the cat sat on the mat and the dog lay by the door", "en", "a", 50),
    (2, "the cat sat on the mat and the dog lay by the door", "en", "a", 50),
    (3, None, None, None, None),
    (4, "", "en", None, 0),
    (None, "le chat est sur la table et le chien dort", "fr", "b", 1),
    (5, "le chat est sur la table et le chien dort ici", None, "b", 1),
    (6, "12345 !!! ???", "en", "b", 1),
    (7, LONG, "en", "a", len(LONG)),
    (8, "mail bob@example.com or call +1 (555) 010-9999 now", "en", "a", 1),
    (9, " \t\n", "fr", "a", 1),
]
KIND = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, KIND)
    for c in ("id", "kept", "n", "k", "h", "spans", "score", "row", "label", "a.b"):
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, 0), (7, 1, 1), (5, 1, 1), (5, 1, 0), (None, 1, 1), (8, None, None), (99, 0, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "the cat sat on the mat and the dog lay by the door"), (2, "short one"), (3, None), (4, "..."), (None, "le chat est"), (1, "the cat")], "item_id long, text string")


def apply(name, docs, labels, items):
    return {
        "toxicity": lambda: toxicity.toxicity(docs, labels),
        "language_id": lambda: language_id.language_id(docs),
        "decontaminate": lambda: decontaminate.decontaminate(docs, items),
        "near_dedup": lambda: near_dedup.near_dedup(docs),
        "sanitise": lambda: sanitise.sanitise(docs),
        "shards": lambda: sharding.shards(docs, 1000),
        "class_lm": lambda: class_lm.class_lm(docs),
        "bpe": lambda: bpe.bpe(docs, bpe.tokenizer_path()),
        "quality": lambda: quality.quality(docs),
        "pages": lambda: html_extract.extract(docs.withColumn("page_id", F.col("doc_id")).withColumn("url", F.col("source")).withColumn("html", F.col("text"))),
    }[name]()


NAMES = ["toxicity", "language_id", "decontaminate", "near_dedup", "sanitise", "shards", "class_lm", "bpe", "quality", "pages"]


@pytest.mark.parametrize("name", NAMES)
def test_messy_rows(name, docs, labels, items):
    got = apply(name, docs, labels, items).toPandas()
    assert len(got) == len(ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(name, docs, labels, items):
    assert apply(name, docs.where("false"), labels.where("false"), items.where("false")).count() == 0


def test_ties_have_defined_results(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(i, i + 19))) for i in (0, 1)]  # 17 three-word shingles each, 16 shared of 18
    near = lambda p: {r["doc_id"]: r["component_id"] for r in near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=p).collect()}
    assert near(88) == {0: 0, 1: 0} and near(89) == {0: 0, 1: 1}
    half = spark.createDataFrame([(1, " ".join(["alpha beta"] + ["x"] * 38)), (2, " ".join(["alpha beta"] + ["x"] * 39))], "doc_id long, text string")
    found = decontaminate.decontaminate(half, spark.createDataFrame([("a", "alpha beta"), ("b", "alpha beta")], "item_id string, text string")).withColumn("bad", decontaminate.contaminated())
    assert {r["doc_id"]: (r["items"], r["bad"]) for r in found.collect()} == {1: (["a", "b"], True), 2: (["a", "b"], False)}
    at = sharding.shards(spark.createDataFrame([(1, "x" * 10), (2, "y" * 10)], "doc_id long, text string"), 20).toPandas()
    assert set(at["depth"]) == {0} and set(at["shard_bytes"]) == {20}


def test_very_long_texts_are_whole(spark):
    long = "one two three " * 150_000
    docs = spark.createDataFrame([(1, long + "mail bob@example.com"), (2, long + "the cat sat on the mat")], "doc_id long, text string").withColumn("lang", F.lit("en")).withColumn("source", F.lit("s"))
    assert {r["doc_id"]: r["n_words"] for r in quality.quality(docs).collect()} == {1: 450_002, 2: 450_006}
    assert {r["doc_id"]: len(r["spans"]) for r in sanitise.sanitise(docs).collect()} == {1: 1, 2: 0}
    found = decontaminate.decontaminate(docs, spark.createDataFrame([(1, "the cat sat on the mat")], "item_id long, text string")).collect()
    assert {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in found} == {1: [], 2: [(len(long), len(long) + 22)]}
    assert {r["n_tokens"] for r in class_lm.class_lm(docs).collect()} == {450_003, 450_007}
    assert {r["doc_id"]: r["n_shingles"] for r in near_dedup.near_dedup(docs, shingle=1).collect()} == {1: 5, 2: 8}


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"
        getConf = staticmethod(lambda: {})

        class _jsc:  # noqa: N801
            sc = staticmethod(lambda: type("S", (), {"getCheckpointDir": staticmethod(lambda: type("O", (), {"isDefined": staticmethod(lambda: False)}))}))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        _common.shared_dir(type("Session", (), {"sparkContext": Context}))


def test_operators_leave_the_session_as_it_is(spark, docs):
    before = dict(spark.conf.getAll)
    class_lm.class_lm(docs).count()
    assert dict(spark.conf.getAll) == before


def test_defined_results(docs, labels, items):
    near = {r["doc_id"]: r for r in near_dedup.near_dedup(docs).collect()}
    assert near[2]["component_id"] == 1 and not near[2]["kept"] and near[1]["kept"]
    assert near[3]["n_shingles"] == 0 and near[3]["kept"] and near[4]["component_id"] == 4 and near[None]["kept"]
    lang = {r["doc_id"]: r["lang_pred"] for r in language_id.language_id(docs).collect()}
    assert [lang[i] for i in (3, 4, 6, 9)] == ["und"] * 4 and lang[1] == "en"
    hit = {r["doc_id"]: r for r in decontaminate.decontaminate(docs, items).collect()}
    assert hit[1]["n_hit"] == 13 and hit[1]["items"] == ["1"] and hit[3]["n_words"] == 0
    clean = {r["doc_id"]: r for r in sanitise.sanitise(docs).collect()}
    assert clean[8]["clean_text"] == "mail [EMAIL] or call [PHONE] now" and clean[3]["clean_text"] is None and clean[4]["clean_text"] == ""
    tokens = {r["doc_id"]: r for r in bpe.bpe(docs, bpe.tokenizer_path()).collect()}
    assert tokens[3]["n_tokens"] == tokens[4]["n_tokens"] == 0 and tokens[9]["ids"] == b""
    lm = {r["doc_id"]: r for r in class_lm.class_lm(docs).collect()}
    assert lm[3]["n_tokens"] == 1 and lm[7]["n_tokens"] == LONG.count(" ") + 1
    size = sharding.shards(docs, 1000).groupBy("shard").agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n")).collect()
    assert all(r["b"] <= 1000 or r["n"] == 1 for r in size)


def test_stages_keep_columns_and_act(spark, docs, tmp_path):
    spark.createDataFrame([(1, "cat sat on the mat and the dog lay by the door")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now, seen = docs, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, str(tmp_path))
        if name != "encoded":
            assert out.columns == docs.columns
        now = spark.createDataFrame(out.collect(), out.schema)
        seen.append(sorted(str(r["doc_id"]) for r in now.collect()))
    assert seen[0] == sorted(["1", "2", "2", "None", "5", "7", "8"])
    assert seen[1] == sorted(["1", "None", "5", "7", "8"])
    assert seen[2] == seen[3] == seen[4] == sorted(["None", "5", "7", "8"])
    text = hashlib.sha256(b"").hexdigest()
    assert text not in {r["ids_sha256"] for r in now.collect()}


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_on_an_empty_table(stage, spark, docs, items, tmp_path):
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0


def test_a_repeated_document_keeps_one_defined_row(spark):
    rows = [(1, "b c", "x"), (1, "a", "y"), (1, "a", "x"), (2, None, "x"), (2, "a", "x"), (3, "a", "x")]
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    first = min(rows[:3], key=lambda r: (digest(r[1]), r[2]))
    for order in itertools.islice(itertools.permutations(rows), 0, 720, 119):
        got = corpus_pipeline.first_of(spark.createDataFrame(list(order), "doc_id long, text string, source string").repartition(3))
        assert sorted(map(tuple, got.collect())) == [first, (2, None, "x"), (3, "a", "x")]
