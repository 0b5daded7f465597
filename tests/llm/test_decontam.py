import re

from closeledger.llm.decontam import clean, matches, op4_decontamination, required, sketch_length
from closeledger.llm.words import shingle_strings


def _brute(docs, items):
    out = set()
    for d, text in docs:
        for i, item in items:
            n = len(re.findall(r"[^\x20\x09-\x0D]+", item or ""))
            if n:
                own = shingle_strings(item, min(5, n))
                shared = len(own & shingle_strings(text or "", min(5, n)))
                if 5 * shared >= 4 * len(own):
                    out.add((d, i, shared, len(own)))
    return out


def test_sketch_never_misses():
    for n in range(1, 400):
        assert sketch_length(n) >= min(n, n - required(n) + 1)


def test_query_matches_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id, r.shared, r.item_shingles) for r in op4_decontamination(spark, sf).collect()}
    assert got == _brute(docs, items)


def test_odd_rows(spark, odd, odd_rows, nothing):
    items = [(1, "quick BROWN fox"), (2, "the quick brown fox jumps over the lazy cat sat down"), (None, "A"), (4, ""), (5, None), (6, "word " * 9)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = matches(odd, bench).collect()
    want = _brute([(r[0], r[1]) for r in odd_rows], items)
    assert {(r.doc_id, r.item_id, r.shared, r.item_shingles) for r in got} == want
    assert len([r for r in got if (r.doc_id, r.item_id) == (0, 1)]) == 3  # rows repeated
    hit = {d for d, *_ in want}
    kept = clean(odd, bench)
    assert kept.columns == odd.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(r[0]) for r in odd_rows if r[0] not in hit)
    assert matches(nothing, bench).count() == 0 and matches(odd, bench.limit(0)).count() == 0
    assert clean(odd, bench.limit(0)).count() == len(odd_rows)


def test_ids_of_any_type(spark):
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([("d1", f"x {text} y"), ("d2", "nothing here")], "doc_id string, text string")
    for kind, item in (("int", 7), ("long", 7), ("short", 7), ("string", "i7")):
        found = matches(docs, spark.createDataFrame([(item, text)], f"item_id {kind}, text string"))
        assert [(r.doc_id, r.item_id) for r in found.collect()] == [("d1", item)]
        assert found.schema["item_id"].dataType.simpleString() in (kind, "bigint", "smallint")
