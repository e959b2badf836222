import random
import tracemalloc
import zlib
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, with_clashes
from public_tokenizers import path
from tokenizers import Tokenizer

from tabfold.llm import common, packing
from tabfold.llm.packing import Example, Limits, Packer, WordTokenizer, pack
from tabfold.llm.queries import TOKENIZER, op8_packing

FILE = path(TOKENIZER)
HARD = ["", None, " ", "Ünïcödé straße ÿ", "it's we'll I'D '' -'s ''re", "a b c İ", "<|endoftext|> x", "x<|startoftext|", "日本語 テスト 12½",
        "éá", "tab\tnl\r\nff\x0c\x1c", "word " * 30_000, "x" * 3000, "​ ­ soft", "### 1234 ***&&&"]


def plain_ids(texts):
    encoder = Tokenizer.from_file(FILE)
    return [[*e.ids, 1] for e in encoder.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_of_words_are_those_of_whole_texts(spark, folder):
    texts = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()] + HARD
    found = WordTokenizer(FILE).ids(texts)
    assert [[*np.frombuffer(f, "<u4").tolist(), 1] for f in found] == plain_ids(texts)


def check(pieces, wanted, limits):
    """Exact round trip of all ids, gapless sequences, limits kept; returns the padding."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
        assert len(p.ids) == 4 * p.length > 0
    for key, ids in wanted.items():
        own = sorted(docs.pop(key), key=lambda p: p.start)
        assert b"".join(p.ids for p in own) == np.array(ids, "<u4").tobytes()
        assert [p.start for p in own] == np.cumsum([0, *[p.length for p in own]])[:-1].tolist()
        assert {p.doc_tokens for p in own} == {len(ids)}
    assert not docs
    padding = 0
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        total = sum(p.length for p in own)
        assert [p.offset for p in own] == np.cumsum([0, *[p.length for p in own]])[:-1].tolist()
        assert total <= limits.tokens and len(own) <= limits.segments
        padding += 0 if total & (total - 1) == 0 else limits.tokens - total
    return padding


@pytest.mark.parametrize("limits", [Limits(), Limits(tokens=64, segments=5, loss=64)])
def test_round_trip(spark, limits):
    rng = random.Random(0)
    texts = HARD + [" ".join(rng.choice(["alpha", "beta", "gam"]) for _ in range(rng.choice([1, 2, 30, 700]))) for _ in range(300)]
    docs = with_clashes(documents(spark, list(enumerate(texts))))
    pieces = pack(docs, FILE, limits=limits).collect()
    padding = check(pieces, dict(enumerate(plain_ids(texts))), limits)
    assert padding <= 0.01 * sum(p.length for p in pieces)


def test_many_tiny_documents(spark):
    pieces = pack(documents(spark, [(i, None) for i in range(700)] + [(1000, "a " * 5000)]), FILE).collect()
    wanted = {i: [1] for i in range(700)} | {1000: plain_ids(["a " * 5000])[0]}
    assert check(pieces, wanted, Limits()) == 0


def test_three_limits_at_once():
    """Pieces of random demands: every limit holds in every sequence and nothing is lost."""
    rng = random.Random(1)
    limits, placed = Limits(tokens=100, segments=6, loss=30), []
    packer = Packer(limits, lambda *p: placed.append((p[0], p[1], p[2], p[3], p[4], max(0, p[3] + p[4] - max(p[3] + 1, p[2].loss_from)))))
    sizes = {}
    for i in range(500):
        n = rng.choice([1, 3, 20, 99, 250])
        sizes[i] = n
        packer.add(Example(i, bytes(4 * n), rng.randrange(n + 1)))
    packer.finish()
    used, got = defaultdict(lambda: [0, 0, 0]), defaultdict(int)
    for sequence, offset, example, start, n, loss in placed:
        assert offset == used[sequence][0] and start == got[example.key]
        used[sequence] = [used[sequence][0] + n, used[sequence][1] + 1, used[sequence][2] + loss]
        got[example.key] += n
    assert got == sizes
    assert all(t <= 100 and s <= 6 and b <= 30 for t, s, b in used.values())


def test_prompts_bear_no_loss(spark):
    rows = spark.createDataFrame([(1, "question one two", "answer"), (2, None, "alone")], "doc_id long, ask string, text string")
    pieces = pack(rows, FILE, prompt="ask").collect()
    ids = b"".join(p.ids for p in sorted(pieces, key=lambda p: p.start) if p.doc_id == 1)
    assert ids == np.array(plain_ids(["question one two"])[0][:-1] + plain_ids(["answer"])[0], "<u4").tobytes()


def test_query_and_empty(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    ids = dict(zip(texts, plain_ids(texts.values())))
    for p in op8_packing(spark, folder).collect():
        assert p.ids_crc32 == zlib.crc32(np.array(ids[p.doc_id][p.start : p.start + p.length], "<u4").tobytes())
    assert pack(documents(spark, []), FILE).collect() == []


class OneBatch:
    """Stands for a table: what ``pack`` would run in a task runs here."""

    def __init__(self, spark):
        self.schema = documents(spark, []).select("doc_id", "text").schema

    def select(self, *names):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_memory_of_a_task(spark, monkeypatch):
    """Words of a few texts are held at a time, not those of megabytes, and what is free goes back to the system."""
    monkeypatch.setattr(packing.TaskContext, "get", classmethod(lambda _: SimpleNamespace(partitionId=lambda: 0)))
    trims = []
    monkeypatch.setattr(common, "_trim", lambda: trims.append)
    rng = random.Random(2)
    words = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(100)]
    texts = [" ".join(rng.choices(words, k=5000)) for _ in range(300)]
    batch = pa.record_batch([pa.array(range(300)), pa.array(texts)], names=["doc_id", "text"])
    run = pack(OneBatch(spark), FILE)
    assert sum(1 for _ in run(iter([batch.slice(0, 1)])))  # the tokenizer is loaded
    trims.clear()
    tracemalloc.start()
    pieces = sum(b.num_rows for b in run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert pieces >= 300 and len(trims) >= 2
    assert peak < 45 << 20


def test_pieces_are_handed_on_by_the_megabyte(spark, monkeypatch):
    """A block of 2M tokens and its end do not wait for one large batch."""
    monkeypatch.setattr(packing.TaskContext, "get", classmethod(lambda _: SimpleNamespace(partitionId=lambda: 0)))
    texts = ["same words " * 900] * 1300
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    handed = list(pack(OneBatch(spark), FILE)(iter([batch])))
    assert sum(sum(b["length"].to_pylist()) for b in handed) == 1300 * len(plain_ids(texts[:1])[0])
    assert max(b.nbytes for b in handed) < 2 << 20
