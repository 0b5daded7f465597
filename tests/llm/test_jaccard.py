import random
from collections import Counter

import numpy as np
from jaccard_brute import brute

from closeledger.llm import jaccard
from closeledger.llm.bits import among
from closeledger.llm.jaccard import grouped, near_duplicate_stage, op9_jaccard_join, prefix_length, signature
from closeledger.llm.words import shingle_set, shingle_strings


def _got(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect()), key=repr)


def test_prefix_length_is_the_least_that_never_misses():
    for n in range(1, 300):
        assert prefix_length(n) == n - (-(-80 * n // 100)) + 1


def test_groups_match_brute_force(spark):
    rng, rows = random.Random(5), []
    words = [f"w{i}" for i in range(300)]
    for _ in range(20):
        base = [rng.choice(words) for _ in range(rng.choice([1, 3, 5, 6, 30, 80, 200]))]
        for _ in range(rng.randrange(1, 8)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(words).upper()
            rows.append(" ".join(copy))
    rows = [(i * 3 % 101 if i % 9 else None, t) for i, t in enumerate(rows)]
    rows += [rows[5], rows[5]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(grouped(docs)) == sorted(brute(rows), key=repr)


def test_odd_rows(spark, odd, odd_rows, nothing):
    assert _got(grouped(odd)) == sorted(brute([(r[0], r[1]) for r in odd_rows]), key=repr)
    assert grouped(nothing).count() == 0
    kept = near_duplicate_stage(spark, odd, "")
    assert kept.columns == odd.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[0] == 1 and ids[1] == 0  # three equal rows, and a copy with another id
    assert all(ids[i] == 1 for i in range(2, 11)) and ids[None] == 2


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert _got(op9_jaccard_join(spark, sf)) == sorted(brute(docs), key=repr)


def test_every_link_is_found(spark, odd, odd_rows, monkeypatch):
    """A group of near copies has all its links, not a spanning set; small
    blocks make several tiles of it."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[:k] + [f"x{k}"] + base[k + 1 :]) for k in range(0, 60, 2)] + [" ".join(base)] * 3
    texts += [" ".join(rng.choice(base) for _ in range(40)) for _ in range(5)] + ["", None]
    rows = list(enumerate(texts))

    def brute_links(rows):
        sets = [shingle_strings(t or "") for _, t in rows]
        near = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
        return sorted(((d, sum(bool(s) and bool(o) and near(s, o) for j, o in enumerate(sets) if j != i)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)

    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for classes in (jaccard.BLOCK_CLASSES, 7):
        monkeypatch.setattr(jaccard, "BLOCK_CLASSES", classes)
        assert sorted(((r.doc_id, r.n_links) for r in jaccard.joined(docs).collect()), key=repr) == brute_links(rows)
        if classes > 7:
            continue
        got = [(r.u, r.v) for r in jaccard.linked_classes(docs).collect()]
        distinct = {frozenset(shingle_strings(t or "")) for t in texts} - {frozenset()}
        linked = sum(100 * len(a & b) >= 80 * len(a | b) for a in distinct for b in distinct if a is not b) // 2
        assert len(got) == len(set(got)) == linked > len(distinct)
    assert sorted(((r.doc_id, r.n_links) for r in jaccard.joined(odd).collect()), key=repr) == brute_links([(r[0], r[1]) for r in odd_rows])


def test_common_shingles_and_many_ranges(spark, sf, monkeypatch):
    """Shingles of many classes go by their counters, ranges are many and
    batches small; the groups stay those of brute force."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    passage = " ".join(f"p{i}" for i in range(30))
    docs += [(10_000 + i, f"{passage} own{i} " + " ".join(f"t{i}.{j}" for j in range(3))) for i in range(60)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(jaccard, "TASK_BYTES", 100_000)
    monkeypatch.setattr(jaccard, "ENTRIES", 50)
    want = sorted(brute(docs), key=repr)
    for few in (20, 0):  # the passage by its counter; every shingle
        monkeypatch.setattr(jaccard, "COMMON", 10**9)
        monkeypatch.setattr(jaccard, "FAR", 0)
        monkeypatch.setattr(jaccard, "FEW", few)
        assert _got(grouped(table)) == want


def test_entries_are_rare_first_and_exact(spark, monkeypatch):
    rng = random.Random(2)
    base = [[f"{d}.{i}" for i in range(40)] for d in range(6)]
    texts = [" ".join(w if rng.random() > 0.03 else f"n{rng.random()}" for w in base[rng.randrange(6)]) for _ in range(50)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    kept = {}
    monkeypatch.setattr(jaccard, "links", lambda docs, classes, found: kept.update(found=found.collect()) or spark.createDataFrame([], "node long, root long"))
    grouped(table).collect()
    sets = {signature(s): s for s in (shingle_set(t) for t in texts)}
    held = Counter(h for s in sets.values() for h in s.tolist())
    want = set()
    for node, s in sets.items():
        order = sorted(s.tolist(), key=lambda h: (held[h], h))
        own = sum(held[h] == 1 for h in order)
        if 5 * (len(order) - own) >= 4 * len(order):
            want |= {(np.uint64(h).view(np.int64).item(), node, len(order), i, i - own) for i, h in enumerate(order[: prefix_length(len(order))]) if i >= own}
    assert {(r.h, r.node, r.n, r.at, r.before) for r in kept["found"]} == want and len(kept["found"]) == len(want) > 50
    by_place = {(r.node, r.before): r for r in kept["found"]}
    for r in kept["found"]:
        assert r.near == [by_place[r.node, r.before - k].h for k in range(1, min(r.before, jaccard.NEAR) + 1)]


def test_verification_tests_texts_in_spark(spark):
    """The texts of pairs are found without a Python worker of their own."""
    texts = [" ".join(f"w{i}" for i in range(50)), " ".join(f"w{i}" for i in range(51)), "a b c d e f", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    placed = {r.doc_id: r.place for r in docs.select("doc_id", jaccard.place_of().alias("place")).collect()}
    a, b, c = (signature(shingle_set(t)) for t in texts[:3])
    pairs = spark.createDataFrame([(a, b, placed[0], placed[1]), (a, c, placed[0], placed[2])], "a long, b long, a_place long, b_place long")
    out = jaccard.verified(pairs, docs)
    assert [(r.u, r.v) for r in out.collect()] == [(a, b)]
    assert "ArrowEvalPython" not in out._jdf.queryExecution().executedPlan().toString()


def test_rows_among_keys_are_all_found(spark):
    rng = random.Random(3)
    keys = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(200)] + [0, -1, 63, 64, (1 << 63) - 1, -(1 << 63)]
    others = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(200)]
    rows = spark.createDataFrame([(k, str(k)) for k in [*keys, *keys[:3], *others]], "place long, text string")
    held = spark.createDataFrame([(k,) for k in [*keys, *keys]], "place long")
    got = Counter(r.place for r in among(rows, held, "place").collect())
    assert all(got[k] == (2 if k in keys[:3] else 1) for k in keys)
    mask = (1 << 24) - 1
    slots = {k & mask for k in keys}
    assert {k for k in got} == {k for k in [*keys, *others] if k & mask in slots}
    assert among(rows, held.limit(0), "place").count() == 0
