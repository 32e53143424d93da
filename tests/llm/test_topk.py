"""What the three phases of the top-k search hand on."""

import numpy as np

from wellspring.llm import topk_search as topk
from wellspring.llm.store import staged
from wellspring.llm.topk_search import topk_search


def test_topk_hands_on_few_rows_and_broadcasts_no_vectors(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vectors = {i: np.floor(256 * np.float32(rng.normal(size=8)).astype(float)).astype(int) for i in range(600)}
    df = spark.createDataFrame([(i, [float(x) / 256 for x in v]) for i, v in vectors.items()], "vec_id long, embedding array<double>")
    held, plans = {}, {}

    def stage(df, name, lasting=False):
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        held[name] = staged(df, name)
        return held[name]

    monkeypatch.setattr(topk, "staged", stage)
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 5)
    got = sorted(map(tuple, topk_search(df).collect()))
    want = []
    for q in range(0, 600, 50):
        best = sorted((-int(vectors[q] @ v), i) for i, v in vectors.items() if i != q)[:5]
        want += [(q, k, i, -s) for k, (s, i) in enumerate(best, 1)]
    assert got == sorted(want)
    # of 12 x 600 pairs about k + 1 a query leave the blocks
    assert 12 * 6 <= held["entries"].count() <= 12 * 8
    # queries are repeated for every block, so they must not be broadcast
    assert all("BroadcastExchange" not in p for name in ("lists", "queries") for p in plans[name])
    assert "SortMergeJoin [block" in plans["entries"][0]
