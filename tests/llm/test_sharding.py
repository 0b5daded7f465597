import zlib
from collections import Counter

import pytest

from closeledger.llm.sharding import manifest, op1_hilbert_sharding, shards, write_shards


def _check(rows, count):
    sizes = Counter(r.shard for r in rows)
    assert max(sizes[s] for s in range(count)) - min(sizes[s] for s in range(count)) <= 1
    for s in range(count):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_rows_law_on_odd_rows(odd, odd_rows):
    rows = shards(odd, 4)[0].collect()
    _check(rows, 4)
    want = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in odd_rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want


def test_empty_table(nothing):
    assert shards(nothing)[0].count() == 0


def test_query_and_manifest(spark, sf):
    rows = op1_hilbert_sharding(spark, sf).collect()
    _check(rows, 24)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert len(rows) == docs.count()
    ranges = manifest(shards(docs)[0]).collect()
    # the curve keeps a shard's cells together: shards miss part of most dimensions
    narrow = sum(r.max_source - r.min_source < 62 for r in ranges) + sum(r.max_size - r.min_size < 62 for r in ranges)
    assert narrow > len(ranges) // 2


def test_files_hold_the_reported_shards(spark, odd, odd_rows, scratch):
    """A hot repeated row is dealt over shards, in the files too."""
    hot = odd.where("doc_id = 0").limit(1)
    docs = odd.drop("shard")
    for _ in range(6):
        hot = hot.unionByName(hot)
    docs = docs.unionByName(hot.drop("shard"))
    placed = write_shards(docs, f"{scratch}/out", 8).collect()
    _check(placed, 8)
    back = spark.read.parquet(f"{scratch}/out")
    assert Counter(r.shard for r in back.collect()) == Counter(r.shard for r in placed)
    key = lambda r: (r.shard, r.doc_id, zlib.crc32((r.text or "").encode()))
    assert Counter(map(key, back.collect())) == Counter((r.shard, r.doc_id, r.text_crc32) for r in placed)
    assert sorted(back.drop("shard").columns) == sorted(docs.columns)
    with pytest.raises(ValueError, match="name the folders otherwise"):
        write_shards(odd, f"{scratch}/other")
    assert write_shards(odd, f"{scratch}/other", 3, "part").count() == len(odd_rows)
    assert "shard" in spark.read.parquet(f"{scratch}/other").columns
