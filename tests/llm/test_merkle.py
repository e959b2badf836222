"""The manifest against one built node by node in plain Python."""

import zlib
from hashlib import sha256

import pytest
from helpers import documents, same_rows, with_clashes
from pyspark.sql import functions as F

from tabfold.llm.common import hash_part, lower_ascii
from tabfold.llm.merkle import digest_of, manifest
from tabfold.llm.queries import MANIFEST_FIELDS


def h(text):
    return sha256(text.encode()).hexdigest()


def lowered(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def leaf(row, text):
    coded = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h("".join(map(coded, (row["doc_id"], row["source"], row["lang"], row["n_chars"], text))))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def way(levels, at):
    for nodes in levels[:-1]:
        run = nodes[at - at % 16 : at - at % 16 + 16]
        yield run[: at % 16], run[at % 16 + 1 :]
        at //= 16


def brute(rows):
    of = {}
    for r in rows:
        tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        of.setdefault(r["source"], []).append((r["doc_id"], leaf(r, r["text"]), leaf(r, lowered(r["text"])) if tampered else None))
    names = sorted(of, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[1] for x in sorted(of[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out, copies = [], []
    for s in names:
        for at, (i, own, new) in enumerate(sorted(of[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))):
            path = [*way(trees[s], at), *way(top, names.index(s))]
            folded, nodes = new or own, [new]
            for left, right in path:
                folded = h("".join([*left, folded, *right]))
                nodes.append(folded)
            proof = h("".join("".join(a + b) for a, b in path))
            out.append((i, own, trees[s][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
            if new:
                copies += [(s, i, at, height, d) for height, d in enumerate(nodes)]
    return out, copies


def built(df, height):
    return manifest(
        df, id="doc_id", group="source", fields=MANIFEST_FIELDS, height=height,
        changed={"text": lower_ascii(F.col("text"))}, when=hash_part(5, F.col("doc_id")) == 0,
    )


@pytest.mark.parametrize("height", [1, 2, 3])
def test_equals_a_tree_built_node_by_node(spark, height):
    rows = [(i, f"Text {i % 50} Ärger" if i % 7 else None, "en" if i % 3 else None, "hot" if i % 3 else f"s{i % 40}") for i in range(900)]
    rows += [(None, "no id", None, None), (None, "No id", None, None), (5, "", "", ""), (5, "", "", ""), (1 << 40, "long " * 30000, "en", "é")]
    df = with_clashes(documents(spark, rows)).repartition(7)
    tree = built(df, height)
    proofs, copies = brute([r.asDict() for r in df.collect()])
    assert same_rows(tree.proofs().collect(), proofs)
    assert same_rows(tree.versions().collect(), copies)


@pytest.mark.parametrize("n", [1, 16, 17, 257])
def test_sizes_about_a_run(spark, n):
    df = documents(spark, [(i, "T", None, "s") for i in range(n)])
    assert same_rows(built(df, 1).proofs().collect(), brute([r.asDict() for r in df.collect()])[0])


def test_many_sources_of_one_leaf(spark):
    df = documents(spark, [(i, "T", None, f"s{i}") for i in range(300)])
    assert same_rows(built(df, 1).proofs().collect(), brute([r.asDict() for r in df.collect()])[0])


def test_empty(spark):
    tree = built(documents(spark, []), 3)
    assert tree.root is None and tree.proofs().collect() == [] and tree.versions().collect() == []


def test_fields_do_not_run_into_each_other(spark):
    df = spark.createDataFrame([("a", "b:1"), ("a1", ":b"), (None, "-"), ("-", None), ("", None), (None, "")], "x string, y string")
    assert df.select(digest_of([F.col("x"), F.col("y")])).distinct().count() == 6
