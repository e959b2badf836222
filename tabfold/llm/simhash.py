"""SimHash near-duplicates by tiled exact comparison.

A document's fingerprint has a bit for each of 64 positions, set if over half the
hashes of its word shingles have it. Equal fingerprints are one class, so groups
of exact copies shrink to a row. The classes are sorted into tiles by population
count, and two tiles are compared, bit by bit for all pairs, unless their counts
differ by more than the radius: differing bits are at least that many. A task
returns a spanning forest of the links it found and not the pairs themselves.

Defined results: a null or empty text has no words and fingerprint zero, which is
linked like any other. Fewer words than a shingle make one shingle of them all.
Repeated rows share their fingerprint. A null id is never a component's smallest
id; where all ids of a component are null, so is ``component_id``. An empty table
gives an empty result. Columns beyond those named do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tabfold.llm.common import WORD_BYTES, as_bytes, batches_by_bytes, numbered, settle
from tabfold.llm.components import components, forest
from tabfold.llm.tiles import pairs_of_tiles, tile_of

BITS = 64
SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
# Fingerprints of a tile: 512 KB, so that a fingerprint is sent to few tasks, and
# some seconds for two tiles.
TILE = 1 << 16
MOST_PARTITIONS = 10_000
# Shingles whose bits are counted at a time; rows and columns of a block of pairs,
# which fits a core's cache.
COUNTED, ROWS, COLUMNS = 1 << 15, 16, 8192

_word = re.compile(WORD_BYTES)


def fingerprint(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """Fingerprint of one text, as an unsigned number."""
    found = _word.findall((text or b"").lower())
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(gaps[: len(found) - words] + 1).tolist()]
    ends = [*gaps[words - 1 :].tolist(), len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends)], dtype="<u8")
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), COUNTED):
        part = hashes[at : at + COUNTED].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return sum(1 << i for i in np.flatnonzero(counts * 2 > len(hashes)).tolist())


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint", words: int = SHINGLE_WORDS) -> DataFrame:
    """All columns of ``docs`` and the fingerprint, a long with the same 64 bits."""
    at = docs.columns.index(text)
    schema = StructType([*docs.schema.fields, StructField(name, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_bytes(batches, at):
            found = np.array([fingerprint(t, words) for t in as_bytes(batch.column(at))], dtype=np.uint64)
            columns = [*batch.columns, pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def hex_digits(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _compare(radius: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        codes = pdf["fingerprint"].to_numpy(np.int64)
        bits = codes.view(np.uint64)
        is_left = pdf["is_left"].to_numpy(bool)
        left, right = np.flatnonzero(is_left), np.flatnonzero(~is_left)
        right = right if len(right) else left
        found = [(np.zeros(0, np.int64),) * 2]
        held = np.empty((ROWS, COLUMNS), np.uint64)
        for at in range(0, len(right), COLUMNS):
            others = right[at : at + COLUMNS]
            for start in range(0, len(left), ROWS):
                some = left[start : start + ROWS]
                block = held[: len(some), : len(others)]
                np.bitwise_xor(bits[some, None], bits[None, others], out=block)
                i, j = (np.bitwise_count(block) <= radius).nonzero()
                if len(i):
                    found.append((some[i], others[j]))
        root = forest(len(codes), *map(np.concatenate, zip(*found)))
        linked = root != np.arange(len(codes))
        return pd.DataFrame({"a": codes[linked], "b": codes[root[linked]]})

    return run


def near_links(codes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) that connect all fingerprints within ``radius`` bits; ``codes`` is distinct.

    There are 65 population counts, so the counts of each are a bounded table.
    """
    counted = codes.withColumn("_count", F.bit_count("fingerprint").cast("int"))
    sizes = {r["_count"]: r["n"] for r in counted.groupBy("_count").agg(F.count("*").alias("n")).collect()}
    n_tiles = [-(-sizes.get(c, 0) // tile) for c in range(BITS + 1)]
    # Tiles are numbered through; those of a count follow each other.
    first = np.concatenate([[0], np.cumsum(n_tiles)]).tolist()
    reach = [list(range(first[max(0, c - radius)], first[min(BITS, c + radius) + 1])) for c in range(BITS + 1)]
    at = lambda values: F.array(*[F.lit(v) for v in values])[F.col("_count")]
    span = lambda pick: at([pick(r) if r else 0 for r in reach])
    own = at(first[:-1]) + tile_of(F.col("fingerprint"), F.greatest(at(n_tiles), F.lit(1)))
    tasks = pairs_of_tiles(counted, own, span(min), span(max)).drop("_count")
    # Small in bytes but not in work: as many partitions as pairs of tiles.
    n_tasks = min(MOST_PARTITIONS, sum(n * len(r) for n, r in zip(n_tiles, reach)) or 1)
    tasks = tasks.repartition(n_tasks, "low", "high")
    return tasks.groupBy("low", "high").applyInPandas(_compare(radius), "a long, b long")


def near_duplicates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, radius: int = RADIUS
) -> DataFrame:
    """One row per document: doc_id, fingerprint (long), component_id."""
    named = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    marked = settle(with_fingerprint(named, words=words).select("doc_id", "fingerprint"), "fingerprints")
    classes = component_of_codes(marked, radius)
    # Classes of copies can be large: their smallest id is found before the join.
    return marked.join(classes, "fingerprint").select("doc_id", "fingerprint", "component_id")


def component_of_codes(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Rows (fingerprint, least, root, component_id) for all rows (doc_id, fingerprint); ``least`` is the smallest id of the fingerprint."""
    classes = settle(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "classes")
    reached = components(near_links(classes.select("fingerprint"), radius))
    rooted = classes.join(reached.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return settle(rooted.join(least, "root").select("fingerprint", "least", "root", "component_id"), "classes")


def one_per_group(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, radius: int = RADIUS
) -> DataFrame:
    """The document with the smallest id of each component, all its columns.

    Of several rows with that id one stays, and one of a component without ids.
    """
    names = docs.columns
    rows, key, body = numbered(docs), f"c{names.index(doc_id)}", f"c{names.index(text)}"
    marked = with_fingerprint(rows.select(F.col(key).alias("doc_id"), F.col(body).alias("text")), words=words)
    marked = settle(marked.select("doc_id", "fingerprint"), "fingerprints")
    classes = component_of_codes(marked, radius)
    # The class that has a component's smallest id; copies meet nowhere, as the id is a part of the key.
    head = F.min(F.struct(F.col("fingerprint").alias("_code"), F.col("least").alias("_id"))).alias("head")
    heads = classes.where(F.col("least").eqNullSafe(F.col("component_id"))).groupBy("root").agg(head).select("root", "head.*")
    of_head = lambda id: (F.col("fingerprint") == F.col("_code")) & F.col(id).eqNullSafe(F.col("_id"))
    counted = marked.join(heads, of_head("doc_id")).groupBy("_code", "_id", "root").agg(F.count("*").alias("n"))
    heads, on = settle(counted, "heads"), of_head(key)
    kept = with_fingerprint(rows, body, words=words).join(heads, on)
    if heads.where("n > 1").limit(1).count():
        # Repeated rows of one id: any of them, the others are the same id and class.
        kept = kept.where("n = 1").unionByName(kept.where("n > 1").dropDuplicates(["root"]))
    return kept.select(rows.columns).toDF(*names)
