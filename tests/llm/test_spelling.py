"""Spelling variants against all pairs of words in plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import documents, same_rows, with_clashes

from tabfold.llm import spelling


def counted(rows, every=31):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = 1 if i is None else zlib.crc32(f"{i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    about = {w: [x for x in words if near(w, x)] for w in words}
    form = {}
    for w, others in about.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 10 * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(about[w]), words[form[w]] if w in form else None))
    return out


def corpus(seed, n_docs):
    draw = random.Random(seed)
    stems = ["".join(draw.choices("abcéÿÞ", k=draw.randint(6, 12))) for _ in range(30)] + ["x" * 400, "aaaaaaaa", "ab" * 9]
    weights = [1000 // (i + 1) for i in range(len(stems))]
    rows = []
    for i in range(n_docs):
        words = draw.choices(stems, weights, k=80)
        for at in range(0, 80, 9):
            word, place = words[at], draw.randrange(len(words[at]))
            words[at] = word[:place] + draw.choice(["", "a", "é" + word[place], "Z"]) + word[place + 1 :]
        rows.append((i, draw.choice([" ", ", ", "1", "\n"]).join(words)))
    return rows


@pytest.mark.parametrize("filter_bytes", [spelling.FILTER_BYTES, 256])
def test_equals_all_pairs(spark, filter_bytes):
    rows = corpus(1, 60) + [(None, "nullish nullish nullist"), (3, None), (4, ""), (4, "Repeated repeated"), (4, "Repeated repeated")]
    df = with_clashes(documents(spark, rows))
    words = spelling.vocabulary(df)
    wanted = counted(rows)
    assert same_rows(words.collect(), wanted.items())
    found = spelling.variants(words, filter_bytes=filter_bytes)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    wanted = brute(wanted)
    assert same_rows(found.collect(), wanted)
    assert any(r[1] for r in wanted)


def test_forms_in_a_chain_and_ties(spark):
    counts = {"abcdefgh": 20000, "abcdefgx": 2000, "abcdefyx": 200, "abcdezyx": 20, "abcdezyy": 2,
              "tieword": 2, "tiewordb": 30, "tieworda": 30, "nearlyten": 3, "nearlytex": 29}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = spelling.variants(words).collect()
    assert same_rows(found, brute(counts))
    by_word = {r.word: r for r in found}
    assert by_word["abcdezyy"].root == "abcdefgh" and by_word["tieword"].form == "tieworda"
    assert by_word["nearlyten"].form is None


def test_one_word_with_many_neighbours(spark):
    counts = {"abcdefghij": 100000} | {"abcdefghij"[:i] + c + "abcdefghij"[i + 1 :]: 5 for i in range(10) for c in "klmnopqrstuvwxyz"}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert same_rows(spelling.variants(words).collect(), brute(counts))


def test_very_long_words(spark):
    long = "".join(random.Random(2).choices("abcdefghij", k=40000))
    counts = {long: 50, long[:20000] + long[20001:]: 5, long[:-1] + "z": 5, "y" + long[1:]: 2, "y" + long[1:-1] + "z": 2}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r.word: (r.form, r.root, r.n_near) for r in spelling.variants(words).collect()}
    assert found[long] == (None, long, 3) and found["y" + long[1:-1] + "z"] == (None, "y" + long[1:-1] + "z", 2)
    assert found["y" + long[1:]][:2] == (long, long)


def test_hashes_of_edits_are_those_of_the_words():
    signs = np.array(sorted(map(ord, "abcé")), np.uint64)
    word = "aabcé"
    texts = set()
    for length, hashes, _, at, new in spelling._edits(spelling._codes([word]), signs):
        for h, p, s in zip(hashes.tolist(), at.tolist(), new.tolist()):
            text = word[:p] + (chr(s) if s else "") + word[p + 1 :]
            assert len(text) == length
            assert h == int((spelling._codes([text]) * spelling._powers(length)).sum(axis=1, dtype=np.uint64)[0])
            assert text not in texts
            texts.add(text)
    smaller = {word[:i] + word[i + 1 :] for i in range(5)}
    greater = {word[:i] + c + word[i + 1 :] for i in range(5) for c in "abcé" if c > word[i]}
    assert texts == smaller | greater


def test_filters_are_bounded_and_cut_into_passes():
    shards = spelling._Shards({7: 1000, 8: 100000, 64: 3}, filter_bytes=1 << 14)
    assert all(size * 8 <= 1 << 14 for size in shards.sizes) and len(shards.sizes) > 10
    assert len(shards.place) == sum(shards.slices.values())


def test_empty(spark):
    assert spelling.variants(spelling.vocabulary(documents(spark, []))).collect() == []
    assert spelling.variants(spelling.vocabulary(documents(spark, [(1, "short words")]))).collect() == []
