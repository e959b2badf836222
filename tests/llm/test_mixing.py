import re
from collections import defaultdict

import pytest
from helpers import documents, with_clashes

from tabfold.llm.mixing import copies, mixed


def rows(n=400):
    out = [(i, " ".join(["w"] * (1 + i * i % 97)), "en", f"s{i % 7}") for i in range(n)]
    return out + [(n + i, "w " * 50, "en", "s0") for i in range(n)] + [(5000, None, "en", "s1"), (5001, "", None, None), (None, "a\u00a0b c", "en", None)]


def waterfill(sizes):
    """Targets by handing out the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, total, open_ = {}, float(sum(sizes.values())), set(names)
    while open_:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] > 3 * sizes[s]]
        if not full:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: 3.0 * sizes[s] for s in full}
        open_ -= set(full)
    return target


def test_targets_and_taken_words(spark):
    docs = with_clashes(documents(spark, rows()))
    found = copies(docs).collect()
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in found:
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
        assert 0 <= r.copies <= 3
    text = {r[0]: r[1] for r in rows()}
    assert len(found) == len(rows())
    for r in found:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", text[r.doc_id] or ""))
        largest[r.source] = max(largest[r.source], r.size)
    for source, target in waterfill(sizes).items():
        row = next(r for r in found if r.source == source)
        assert row.source_size == sizes[source] and row.target == pytest.approx(target)
        assert abs(taken[source] - target) <= max(1, 0.02 * target, 2 if source is None else 0)


def test_reruns_agree_in_any_layout(spark):
    docs = documents(spark, rows())
    one = sorted(map(tuple, copies(docs).collect()), key=repr)
    other = sorted(map(tuple, copies(docs.repartition(13, "text")).collect()), key=repr)
    assert one == other
    assert one != sorted(map(tuple, copies(docs, seed=7).collect()), key=repr)


def test_odds_favour_documents(spark):
    from pyspark.sql import functions as F

    docs = documents(spark, [(i, "w " * 20, "en", f"s{i % 3}") for i in range(3000)])
    found = copies(docs, odds=F.when(F.col("doc_id") < 1500, 9.0)).where("source = 's1'").collect()
    early = sum(r.copies for r in found if r.doc_id < 1500)
    assert early > 0.6 * sum(r.copies for r in found)


def test_documents_come_as_often_as_planned(spark):
    docs = documents(spark, rows())
    again = with_clashes(docs)
    count = defaultdict(int)
    out = mixed(again)
    assert out.columns == again.columns
    for r in out.collect():
        count[r.doc_id] += 1
    assert {r.doc_id: r.copies for r in copies(docs).collect() if r.copies} == dict(count)


def test_repeated_rows_go_together_and_empty_tables(spark):
    docs = documents(spark, [(1, "a b", "en", "x")] * 4 + [(2, "a", "en", "y")])
    found = copies(docs).where("doc_id = 1").collect()
    assert len(found) == 4 and len({r.copies for r in found}) == 1
    empty = documents(spark, [])
    assert copies(empty).collect() == [] and mixed(empty).collect() == []
    assert [r.copies for r in copies(documents(spark, [(1, None, None, None)])).collect()] == [0]
