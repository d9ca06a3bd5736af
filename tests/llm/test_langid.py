import numpy as np
import pytest
from pyspark.sql import functions as F

from kinomill.llm import langid


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))), sample=600)
    return model, langid.predict(docs, model, ["doc_id", "lang", langid.held_out(F.col("doc_id")).alias("held_out")]).collect()


def test_held_out_accuracy(found):
    held = [r for r in found[1] if r["held_out"]]
    assert len(held) > 200
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found[1])


def test_scores_are_calibrated(found):
    held = [r for r in found[1] if r["held_out"]]
    assert abs(np.mean([r["score"] for r in held]) - np.mean([r["lang"] == r["lang_pred"] for r in held])) < 0.05


def test_weights_are_sparse(found):
    assert (found[0].weights == 0).mean() > 0.3


def test_odd_rows(spark, found):
    rows = [(1, None), (2, ""), (3, "12 ½ $$ ..."), (4, "the " * 20_000), (4, "the"), (None, "der und die")]
    docs = spark.createDataFrame([(*r, "x", 2.0) for r in rows], "doc_id long, text string, lang_pred string, score double")
    got = langid.predict(docs, found[0]).collect()
    assert len(got) == len(rows)
    assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in got if r["doc_id"] in (1, 2, 3))
    assert {r["lang_pred"] for r in got if r["doc_id"] == 4} <= set(found[0].languages)


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert langid.predict(docs, langid.train(docs)).first()["lang_pred"] == "und"
    assert langid.predict(docs.limit(0), langid.train(docs.limit(0))).collect() == []


def test_document_frequencies_are_of_all_documents(spark):
    texts = ["ab", "abab", "b", "Ünder"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    got = {r["at"]: r["n"] for r in langid._frequencies(docs).collect()}
    want: dict = {}
    for t in texts:
        for at in set(langid.columns_of(t).tolist()):
            want[at] = want.get(at, 0) + 1
    assert got == want
