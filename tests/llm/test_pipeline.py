import corpus_pipeline
from jaccard_brute import brute

from closeledger.llm.common import stored
from closeledger.llm.decontam import matches
from closeledger.llm.queries import QUERIES


def test_stages_one_by_one(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "n-gram jaccard join", "suffix-array dedup", "benchmark decontamination", "sentencepiece encoding"]
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, sf), "test")
        rows = [(r.doc_id, r.text) for r in before.collect()]
        kept = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "n-gram jaccard join":
            assert kept == {d for d, n, c in brute(rows) if not n or d == c}
        if name == "benchmark decontamination":
            hit = {r.doc_id for r in matches(before, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
            assert kept == {d for d, _ in rows} - hit
        if name == "suffix-array dedup":
            assert kept == {d for d, _ in rows}
        if name != names[-1]:
            assert docs.columns == before.columns
    assert {"n_tokens", "ids_sha256", "decoded_sha256"} < set(docs.columns)


def test_odd_rows(spark, odd, nothing, sf):
    for table in (odd, nothing):
        docs = table
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, sf), "test")
        assert docs.count() <= table.count()


def test_registered_once_each(spark):
    import __spark_entry__

    names = __spark_entry__.queries()
    assert set(QUERIES) < set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
