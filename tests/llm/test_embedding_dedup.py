import math

import numpy as np
from helpers import components, same_rows, with_clashes

from tabfold.llm.embedding_dedup import Quantised, near_duplicates, possible

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(v, label):
    return v is not None and label is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, threshold=0.98):
    n, links = [0] * len(rows), []
    for i, (_, a, la) in enumerate(rows):
        for j, (_, b, lb) in enumerate(rows[:i]):
            if usable(a, la) and usable(b, lb) and la == lb and len(a) == len(b):
                x, y = (np.array(v, np.float32).astype(float) for v in (a, b))
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                    n[i], n[j] = n[i] + 1, n[j] + 1
                    links.append((i, j))
    reached = components(range(len(rows)), links)
    ids = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[reached[i]] = min(r[0], ids.get(reached[i], r[0]))
    return [(r[0], n[i], ids.get(reached[i]), r[0] == ids.get(reached[i])) for i, r in enumerate(rows)]


def vectors():
    rng = np.random.default_rng(0)
    base = rng.normal(size=(30, 8)).astype(np.float32)
    near = np.concatenate([base, base[:10] + rng.normal(size=(10, 8)) * 0.1, base[:10] * 3, base[:5]]).astype(np.float32)
    rows = [(i + 1, v.tolist(), int(i) % 2) for i, v in enumerate(near)]
    one, nan = near[0].tolist(), float("nan")
    rows += [(100, None, 0), (101, [0.0] * 8, 0), (102, one[:7] + [None], 0), (103, one[:7] + [nan], 0), (104, one[:7] + [math.inf], 0)]
    rows += [(105, one, None), (106, one[:7], 0), (107, [], 0), (None, one, 0), (1, one, 0), (1, one, 0), (108, [1e30] * 8, 1), (109, [1e-30] * 8, 1)]
    return rows


def test_against_all_pairs(spark):
    rows = vectors()
    df = with_clashes(spark.createDataFrame(rows, SCHEMA))
    for tile in (4096, 7):
        found = near_duplicates(df, tile=tile)
        assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
        assert same_rows(found.collect(), brute(rows))


def test_large_group_of_near_copies_stays_small(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (np.ones(8) + rng.normal(size=8) * 0.01).tolist(), 1) for i in range(300)]
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA), tile=64).collect()
    assert same_rows(found, [(i, 299, 0, i == 0) for i in range(300)])


def test_bound_holds():
    rng = np.random.default_rng(2)
    a, b = Quantised(rng.normal(size=(200, 16))), Quantised(rng.normal(size=(150, 16)))
    exact = a.unit @ b.unit.T
    for threshold in (0.2, 0.5, 0.8):
        maybe = possible(a, slice(0, 200), b, threshold)
        assert maybe[exact >= threshold].all()
        assert not maybe[exact < threshold - 0.1].any()


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
