import math

import numpy as np
import pytest
from helpers import same_rows, with_clashes
from pyspark.sql import functions as F

from tabfold.llm.topk import BallTree, search, top_k

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5):
    sound = [(i, r[0], [math.floor(256 * float(np.float32(x))) for x in r[1]]) for i, r in enumerate(rows)
             if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    out = []
    for i, key, query in sound:
        if key is None or key % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(query, v)), c is None, c) for j, c, v in sound if j != i and len(v) == len(query)]
        out += [(key, rank + 1, c, -s) for rank, (s, _, c) in enumerate(sorted(scored)[:k])]
    return out


def vectors(n=300):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(n, 6)).astype(np.float32)
    rows = [(i, v.tolist(), None) for i, v in enumerate(base)]
    one = base[0].tolist()
    rows += [(1000 + i, one, 1) for i in range(40)] + [(0, one, 1), (None, one, 1), (50, None, 1), (100, one[:5] + [None], 1)]
    return rows + [(150, one[:5] + [math.nan], 1), (200, one[:3], 1), (201, one[:3], 1), (250, [], 1), (251, [], 1), (300, one[:5] + [math.inf], 1)]


@pytest.mark.parametrize("shard, block", [(16_384, 32_768), (40, 3)])
def test_against_all_rows(spark, shard, block):
    rows = vectors()
    df = with_clashes(spark.createDataFrame(rows, SCHEMA))
    found = top_k(df, F.col("vec_id") % 50 == 0, shard=shard, block=block)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert same_rows(found.collect(), brute(rows))


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(size=(500, 4)) + 50, rng.normal(size=(500, 4)) - 50])
    tree = BallTree(points, leaf=16)
    queries = rng.normal(size=(20, 4)) * 10
    nodes = list(range(len(tree.rows)))
    bounds = tree.bounds(queries, nodes)
    for n in nodes:
        assert ((queries @ points[tree.rows[n]].T).max(axis=1) <= bounds[:, n]).all()
    assert sorted(np.concatenate([tree.rows[n] for n in nodes if tree.children[n] is None]).tolist()) == list(range(1000))
    ahead = np.full((1, 4), 10.0)
    leaves, _ = tree.leaves(ahead, np.array([1900.0]))
    assert 0 < len(leaves) < sum(c is None for c in tree.children) // 2 + 1


def test_floor_and_large_numbers():
    points = np.array([[1 << 27, 1], [1 << 27, 0], [5, 5]], np.int64)
    own = np.array([10])
    query, score, ids = search(points, np.arange(3), np.arange(3), points[:1], own, np.array([-np.inf]), 2)
    assert score.tolist() == [(1 << 54) + 1, 1 << 54] and ids.tolist() == [0, 1]
    query, score, ids = search(points, np.arange(3), np.arange(3), points[:1], own, np.array([float(1 << 60)]), 2)
    assert len(query) == 0


def test_empty(spark):
    assert top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).collect() == []
