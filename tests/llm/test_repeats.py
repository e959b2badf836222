import random
import re
from collections import defaultdict

import pytest
from helpers import WORD, documents, with_clashes

from tabfold.llm.repeats import minimisers, repeats, run_hashes, without_repeats, word_hashes


def words(text):
    return re.findall(WORD, (text or "").encode())


def brute(rows, n):
    """Words of each document that lie in a run of n words which an earlier place has."""
    seen, covered = set(), {}
    for key, text in sorted(dict.fromkeys(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        own, found = words(text), set()
        for i in range(len(own) - n + 1):
            run = tuple(own[i : i + n])
            if run in seen:
                found.update(range(i, i + n))
            seen.add(run)
        covered[key] = covered.get(key, set()) | found
    return covered


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(0)
    text = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    shared = [text(n) for n in (50, 51, 60, 90, 200)]
    out = []
    for i in range(80):
        body = text(rng.choice([5, 60, 300]))
        for passage in rng.sample(shared, rng.randrange(3)):
            at = rng.randrange(len(body) + 1)
            body[at:at] = passage
        out.append((i, rng.choice([" ", "\n"]).join(body)))
    return out + [
        (200, out[3][1]), (201, out[3][1]), (3, out[3][1]), (202, "few words"), (203, "few words"), (204, None), (205, ""),
        (206, "same " * 120), (207, "line of five words here " * 40), (None, out[5][1]), (208, " ".join(shared[0][:49] + ["x"] + shared[0][49:])),
        (209, " ".join(text(20_000) + shared[4])),
    ]


def test_against_all_runs(spark, rows):
    found = repeats(with_clashes(documents(spark, rows))).collect()
    text = {}
    for key, body in rows:
        text.setdefault(key, words(body))
    covered = defaultdict(set)
    order = lambda k: (k is None, k or 0)
    for r in found:
        assert r.end - r.start >= 50
        assert text[r.doc_id][r.start : r.end] == text[r.first_id][r.first_start : r.first_start + r.end - r.start]
        assert (order(r.first_id), r.first_start) < (order(r.doc_id), r.start)
        covered[r.doc_id].update(range(r.start, r.end))
    wanted = {k: v for k, v in brute(rows, 50).items() if v}
    assert {k for k, v in wanted.items() if len(v) >= 53} <= set(covered) <= set(wanted)
    for key, own in wanted.items():
        # Passages are those shared with their first place; a later place may share some words more.
        assert covered[key] <= own and len(own - covered[key]) <= 3 * 2 + 0.01 * len(own)


def test_planted_passages_are_found_whole(spark):
    rng = random.Random(5)
    unique = iter(range(10**6))
    own = lambda n: [f"u{next(unique)}" for _ in range(n)]
    passages = [[f"p{rng.randrange(2000)}" for _ in range(n)] for n in (49, 50, 53, 80, 400)]
    rows = []
    for i in range(60):
        body = own(rng.choice([0, 3, 200]))
        for passage in rng.sample(passages, rng.randrange(1, 4)):
            body += passage + own(rng.choice([1, 100]))
        rows.append((i, " ".join(body)))
    covered = defaultdict(set)
    for r in repeats(documents(spark, rows)).collect():
        covered[r.doc_id].update(range(r.start, r.end))
    assert dict(covered) == {k: v for k, v in brute(rows, 50).items() if v}


def test_cut_texts_keep_one_copy(spark, rows):
    docs = with_clashes(documents(spark, rows))
    kept = without_repeats(docs)
    assert kept.columns == docs.columns
    out = kept.collect()
    covered, text = defaultdict(set), {}
    for r in repeats(docs).collect():
        covered[r.doc_id].update(range(r.start, r.end))
    for key, body in rows:
        text.setdefault(key, words(body))
    for r in out:
        assert words(r.text) == [w for i, w in enumerate(text[r.doc_id]) if i not in covered[r.doc_id]]
    gone = {k for k in text if text[k] and len(covered[k]) == len(text[k])}
    assert sorted({r.doc_id for r in out}, key=repr) == sorted(set(text) - gone, key=repr)
    assert gone >= {200, 201}
    assert next(r.text for r in out if r.doc_id == 204) is None
    assert next(r.text for r in out if r.doc_id == 203) == "few words"


def test_selection_is_that_of_its_definition():
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abc") + rng.choice("xyz") for _ in range(rng.randrange(40))).encode() for _ in range(30)] + [None, b""]
    hashes, counts = word_hashes(texts)
    chosen, keys = minimisers(hashes, counts, 3, 5)
    wanted, start = set(), 0
    for n in counts:
        own = run_hashes(hashes[start : start + n], 3).tolist()
        for i in range(len(own) - 4):
            wanted.update(start + j for j in range(i, i + 5) if own[j] == min(own[i : i + 5]))
        start += n
    assert chosen.tolist() == sorted(wanted)
    same = word_hashes([b"a b c d", b"x a b c d"])[0]
    assert run_hashes(same, 3)[0] == run_hashes(same, 3)[5]


def test_empty(spark):
    empty = documents(spark, [])
    assert repeats(empty).collect() == [] and without_repeats(empty).collect() == []


@pytest.mark.parametrize("size, head", [(50, 49), (51, 49), (52, 48), (60, 47), (90, 49)])
def test_passages_that_an_earlier_document_has_in_part(spark, size, head):
    """The first place of a key shares under 50 words, a later one shares the whole passage."""
    rng = random.Random(size * 100 + head)
    unique = iter(range(10**6))
    own = lambda n: [f"u{next(unique)}" for _ in range(n)]
    rows = []
    for case in range(30):
        passage = [f"p{rng.randrange(10**6)}" for _ in range(size)]
        at = rng.randrange(size - head + 1)
        parts = [passage[at : at + head], passage, passage, passage[: size - 1], passage[1:]]
        rows += [(10 * case + i, " ".join(own(rng.choice([0, 2, 70])) + part + own(rng.choice([0, 1, 80])))) for i, part in enumerate(parts)]
    covered = defaultdict(set)
    for r in repeats(documents(spark, rows)).collect():
        covered[r.doc_id].update(range(r.start, r.end))
    assert dict(covered) == {k: v for k, v in brute(rows, 50).items() if v}


def test_equals_all_runs(spark, rows):
    covered = defaultdict(set)
    for r in repeats(documents(spark, rows)).collect():
        covered[r.doc_id].update(range(r.start, r.end))
    assert dict(covered) == {k: v for k, v in brute(rows, 50).items() if v}
