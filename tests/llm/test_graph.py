import numpy as np

from closeledger.llm import graph


def _roots(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in pairs:
        a, b = sorted((find(u), find(v)))
        root[b] = a
    return {x: find(x) for x in root if find(x) != x}


def test_components_with_few_exchanges_a_step(spark, monkeypatch):
    """Paths, a star, loops and double edges; no step is worked out twice."""
    rng = np.random.default_rng(1)
    pairs = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (3, 2), (2, 3), (900, 900)]
    pairs += [tuple(map(int, rng.integers(200, 320, 2))) for _ in range(90)]
    plans = []
    for name in ("stored", "stored_with"):
        kept = getattr(graph, name, None)
        noted = lambda df, *a, kept=kept, **b: (plans.append(df._jdf.queryExecution().executedPlan().toString()), kept(df, *a, **b))[1]
        monkeypatch.setattr(graph, name, noted, raising=False)
    edges = spark.createDataFrame(pairs, "u long, v long")
    assert {r.node: r.root for r in graph.components(edges).collect()} == _roots(pairs)
    assert plans and max(p.count(" Exchange ") for p in plans) <= 3
