"""The search of neighbours over many shards: right answers, and no copies of the queries for the driver to broadcast."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import neighbours


def test_search_reads_blocks_past_graphs_without_copies(spark):
    rng = np.random.default_rng(3)
    vectors = [rng.normal(size=8).astype(np.float32) for _ in range(500)] + [rng.normal(size=5).astype(np.float32) for _ in range(100)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    valid = neighbours.valid(df)
    graphs = neighbours.index(valid, 3, shard=20)
    assert graphs.agg(F.max("shard")).first()[0] + 1 >= 25
    found = neighbours.search(graphs, valid.where("vec_id % 2 = 0"), 3, block=16)
    answers: dict = {}
    for r in found.collect():
        answers.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and "Generate" not in plan
    assert set(answers) == set(range(0, 600, 2))
    hits = 0
    for q, three in answers.items():
        a = vectors[q].astype(float)
        best = sorted((-(a @ v) / np.linalg.norm(a) / np.linalg.norm(v), i) for i, v in ((i, v.astype(float)) for i, v in enumerate(vectors)) if i != q and len(v) == len(a))[:3]
        assert [x[0] for x in sorted(three)] == [1, 2, 3]
        hits += len({i for _, i in best} & {i for _, i, _ in three})
        for _, i, score in three:
            b = vectors[i].astype(float)
            assert len(b) == len(a) and score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)
    assert hits >= 0.99 * 3 * len(answers)
