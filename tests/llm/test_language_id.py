"""Language identification: held-out accuracy and defined results."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import frame, rows_of
from tracemill.llm import language_id as L

DOCS = "/root/testdata/sf0.01/documents.parquet"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(DOCS).withColumn("held_out", L.held_out(F.col("doc_id")))


@pytest.fixture(scope="module")
def model(docs):
    return L.train(docs.where("not held_out"))


def test_held_out_accuracy(docs, model):
    found = L.identify(docs.where("held_out"), model)
    right, n = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right / n > 0.99
    # Short texts too: the first words of each document.
    short = docs.where("held_out").withColumn("text", F.substring("text", 1, 40))
    right, n = L.identify(short, model).agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / n > 0.95


def test_scores_equal_a_plain_sum(docs, model):
    texts = [r["text"] for r in docs.orderBy("doc_id").limit(20).collect()]
    best, sure = L.score_texts(model, texts)
    for text, b, s in zip(texts, best, sure, strict=True):
        codes, _ = L.code_points([text])
        sums = model.prior.copy()
        for size in L.SIZES:
            sums += model.matrix[L.gram_buckets(codes, size, model.bits)].astype(float).sum(axis=0)
        share = np.exp(sums - sums.max())
        assert b == sums.argmax() and s == pytest.approx((share / share.sum()).max(), abs=1e-6)


def test_model_does_not_depend_on_partitions(docs, model):
    again = L.train(docs.where("not held_out").repartition(7))
    assert again.languages == model.languages and np.array_equal(again.matrix, model.matrix)


def test_training_is_bounded(docs):
    few = L.train(docs, max_docs=50)
    assert set(few.languages) <= {"de", "en", "es", "fr"} and few.languages


def test_rare_languages_are_learned(spark):
    copies = spark.range(60_000).select(F.lit("the cat and the dog went to the house").alias("text"), F.lit("en").alias("lang"))
    german = spark.range(300).select(F.concat(F.lit("der Hund und die Katze gehen nach Haus "), F.col("id")).alias("text"), F.lit("de").alias("lang"))
    polish = frame(spark, [("kot i pies idą do domu", "pl"), ("dzień dobry, jak się masz", "pl"), ("wszystko jest dobrze", "pl")], "text string, lang string")
    many = spark.range(60_000).select(F.concat(F.lit("the cat and the dog went to the house "), F.col("id")).alias("text"), F.lit("en").alias("lang"))
    for table, languages, sample in ((copies.union(german), ["de", "en"], "die Katze und der Hund"), (many.union(polish), ["en", "pl"], "pies i kot")):
        model = L.train(table)
        assert model.languages == languages
        rows = frame(spark, [(sample,), ("the dog and the cat",)], "text string")
        assert rows_of(L.identify(rows, model), "lang_pred") == sorted([(next(x for x in languages if x != "en"),), ("en",)])


def test_defined_results(spark, model):
    rows = [(1, None, "a"), (2, "", "b"), (3, " 12 !! ", "c"), (4, "the of and to in is", "d"), (4, "the of and to in is", "d"), (None, "der die das und nicht", None)]
    rows += [(5, "and the " * 200_000, "e"), (6, "de la que el en y los del " * 3, "f")]
    got = rows_of(L.identify(frame(spark, rows, "doc_id long, text string, lang string"), model), "doc_id", "lang_pred")
    assert got == sorted([(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (None, "de"), (5, "en"), (6, "es")], key=repr)
    scores = [r["score"] for r in L.identify(frame(spark, rows, "doc_id long, text string, lang string"), model).collect()]
    assert all(0 <= s <= 1 for s in scores)


def test_empty_tables_and_clashes(spark, model):
    empty = frame(spark, [], "doc_id long, text string, lang string")
    assert L.identify(empty, model).count() == 0
    nothing = L.train(empty)
    assert rows_of(L.identify(frame(spark, [(1, "some text")]), nothing), "lang_pred", "score") == [("und", 0.0)]
    clash = frame(spark, [(1, "some text", 0.5)], "doc_id long, text string, score double")
    with pytest.raises(ValueError, match="score"):
        L.identify(clash, model)
    assert L.identify(clash, model, names=("a", "b")).columns == ["doc_id", "text", "score", "a", "b"]


def test_held_out_rows(spark):
    import zlib

    got = {r["doc_id"]: r["h"] for r in spark.range(200).withColumnRenamed("id", "doc_id").select("doc_id", L.held_out(F.col("doc_id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(200)}
