import random
import re

import pytest
import xxhash
from helpers import WORD, components, documents, same_rows, with_clashes

from tabfold.llm import simhash
from tabfold.llm.components import components as reached
from tabfold.llm.simhash import fingerprint, hex_digits, near_duplicates, near_links, one_per_group


def brute_fingerprint(text, size=4):
    words = re.findall(WORD, (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute(rows):
    codes = [brute_fingerprint(r[1]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (codes[i] ^ codes[j]).bit_count() <= 4]
    of = components(range(len(rows)), links)
    ids = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[of[i]] = min(r[0], ids.get(of[i], r[0]))
    return [(r[0], f"{codes[i]:016x}", ids.get(of[i])) for i, r in enumerate(rows)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(0)
    words = [f"w{i}" for i in range(400)]
    out = []
    for i in range(60):
        text = [rng.choice(words) for _ in range(rng.choice([3, 4, 5, 300]))]
        out.append((i, " ".join(text)))
        for copy in range(3):
            text[rng.randrange(len(text))] = "x"
            out.append((1000 + 10 * i + copy, " ".join(text)))
    return out + [(5, out[0][1]), (5, out[0][1]), (None, out[0][1]), (7000, None), (7001, ""), (7002, " \n"), (None, "unlike any other"),
                  (7003, "É é   A a"), (7004, "word " * 50_000)]


def test_against_all_pairs(spark, rows):
    found = near_duplicates(with_clashes(documents(spark, rows)))
    assert same_rows(found.select("doc_id", hex_digits(found["fingerprint"]), "component_id").collect(), brute(rows))


@pytest.mark.parametrize("tile", [3, 50])
def test_links_in_small_tiles(spark, tile):
    rng = random.Random(1)
    codes = {rng.getrandbits(64) for _ in range(60)} | {0, 1, 2**64 - 1}
    codes |= {c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for c in list(codes) for _ in range(3)}
    signed = [c - 2**64 if c >= 2**63 else c for c in codes]
    df = spark.createDataFrame([(c,) for c in signed], "fingerprint long")
    found = {r.node: r.root for r in reached(near_links(df, tile=tile)).collect()}
    pairs = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    wanted = components(signed, pairs)
    assert found == {n: r for n, r in wanted.items() if r != n or any(n in p for p in pairs)}


def test_one_document_of_each_group_stays(spark, rows):
    docs = with_clashes(documents(spark, rows))
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    heads = {(c, c) for _, _, c in brute(rows)}
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((c for c, _ in heads), key=repr)


def test_large_component_in_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(3, 3), (7, 6)], "a long, b long")
    assert {(r.node, r.root) for r in reached(links).collect()} == {(i, 0) for i in range(201)}
    assert reached(links.where("a < 0")).collect() == []


def test_fingerprint_in_parts(monkeypatch):
    text = " ".join(str(i) for i in range(500)).encode()
    whole = fingerprint(text)
    monkeypatch.setattr(simhash, "COUNTED", 7)
    assert fingerprint(text) == whole == brute_fingerprint(text.decode())


def test_empty(spark):
    empty = documents(spark, [])
    assert near_duplicates(empty).collect() == [] and one_per_group(empty).collect() == []
