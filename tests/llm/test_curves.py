import numpy as np

from closeledger.llm.curves import neighbours, op5_curve_neighbours


def _brute(ids, x, query, k):
    own = int(np.flatnonzero(ids == query)[0])
    d = np.sqrt(((x - x[own]) ** 2).sum(axis=1))
    order = [i for i in np.lexsort((ids, d)) if ids[i] != query][:k]
    return [(int(ids[i]), float(d[i])) for i in order]


def test_recall(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    got = {}
    for r in op5_curve_neighbours(spark, sf).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == {int(i) for i in ids if i % 100 == 0}
    hits = 0
    for q, ranks in got.items():
        assert sorted(ranks) == list(range(1, 11))
        want = _brute(ids, x, q, 10)
        hits += len({v for v, _ in want} & {v for v, _ in ranks.values()})
    assert hits >= 0.9 * 10 * len(got)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0]) for i in range(40)]  # one vector that many rows share
    rows += [(50 + i, [float(i), 0.5]) for i in range(1, 6)]
    rows += [(100, None), (101, []), (102, [0.0, 0.0]), (103, [nan, 1.0]), (104, [inf, 1.0]), (105, [None, 1.0]), (106, [1.0]), (None, [1.0, 2.0])]
    rows += [(50 + 1, [1.0, 0.5])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = spark.createDataFrame([(0,), (7,), (51,), (102,), (999,)], "vec_id long")
    got = {}
    for r in neighbours(vectors, asked, 10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {0, 7, 51}
    assert [v for _, v, _ in sorted(got[0])] == list(range(1, 11))
    assert [v for _, v, _ in sorted(got[7])] == [0, 1, 2, 3, 4, 5, 6, 8, 9, 10]
    ids = np.array([*range(40), *range(51, 56)])
    x = np.array([[1.0, 2.0]] * 40 + [[float(i), 0.5] for i in range(1, 6)])
    assert [(v, s) for _, v, s in sorted(got[51])] == _brute(ids, x, 51, 10)
    assert neighbours(vectors.limit(0), asked).count() == 0
    few = vectors.where("vec_id > 50 and vec_id < 54")
    assert neighbours(few, few.select("vec_id")).count() == 6
