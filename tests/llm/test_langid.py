from pyspark.sql import functions as F

from closeledger.llm.langid import op2_language_id, predict, train


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = op2_language_id(spark, sf).where("held_out").join(docs, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(odd, nothing):
    rows = predict(odd, train(odd), F.col("doc_id")).collect()
    assert len(rows) == odd.count()
    assert {r.lang_pred for r in rows if r.doc_id in (2, 3, 4, 8)} == {"und"}
    assert {r.lang_pred for r in rows} == {"und", "en"}
    nobody = predict(odd, train(nothing), F.col("doc_id")).collect()
    assert {(r.lang_pred, r.score) for r in nobody} == {("und", 0.0)}
    assert predict(nothing, train(odd), F.col("doc_id")).count() == 0
