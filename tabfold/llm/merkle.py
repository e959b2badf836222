"""A dataset manifest as a persistent Merkle tree.

Every row is a leaf; the rows of a group (a source) form a tree in which each run of
16 consecutive nodes has one parent, and the roots of the groups, in the groups'
order, form one more tree above them. A tree is built in aligned blocks of 16**3
nodes, one block a row: the nodes of a block become its root, the roots of a
group's blocks are the nodes of the next tower, and so on until each group has one.

The tree is persistent. A changed leaf makes a version that copies its ancestors
only and shares every other node with the first tree: the copies within a block are
made where the block lies, and go on through the towers above along the siblings
that were handed down to the block from its parents. No task holds more than one
block and the siblings above it, and nothing is collected but one digest a group's
block for the root.

Defined results: null fields count as ``-``; a null group is a group of its own and
comes first; leaves of a group ascend by id, nulls first, equal ids by digest, so that
repeated rows are leaves of their own. A group of one row has that leaf as its root.
An empty table gives no rows and no root. A very long text costs its digest, in the
JVM, and twice its size in that task; nothing else carries it on. Other columns,
whatever their names, do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabfold.llm.common import settle

ARITY = 16
BLOCK_LEVELS = 3
# monotonically_increasing_id keeps the partition above these bits.
ROW_BITS = 33


def digest_of(fields: Sequence[Column]) -> Column:
    """Lower-case hex sha256 of the fields, each as byte count, colon and value, or ``-`` for null."""
    texts = [f.cast("string") for f in fields]
    coded = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*coded).cast("binary"), 256)


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _levels(nodes: list[str], n_of_group: int, height: int) -> list[list[str]]:
    """The nodes of a block level by level, up to the block's root.

    A block that is its whole group ends as soon as one node is left; one of several
    climbs ``height`` levels, so that the towers above find aligned nodes.
    """
    levels = [nodes]
    whole = n_of_group <= ARITY**height
    while len(levels[-1]) > 1 or (not whole and len(levels) <= height):
        below = levels[-1]
        levels.append([_hash("".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)])
    return levels


def _beside(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """What stands left and right of a node, and of its ancestors, in their runs."""
    found = []
    for nodes in levels[:-1]:
        start = at - at % ARITY
        found.append(("".join(nodes[start:at]), "".join(nodes[at + 1 : start + ARITY])))
        at //= ARITY
    return found


def _climb(digest: str, path: list[tuple[str, str]]) -> list[str]:
    """A version of a node: the copies of its ancestors, the root last."""
    copies = []
    for left, right in path:
        digest = _hash(left + digest + right)
        copies.append(digest)
    return copies


def _indexed(rows: DataFrame, order: list[Column], stem: str) -> DataFrame:
    """``index`` of each row within its ``grp`` in the given order, and ``n`` of that group.

    A range sort numbers the rows of each partition; per partition and group only a
    count goes on, so a group that fills many partitions meets in no task. The written
    rows fix the numbers.
    """
    mark = F.monotonically_increasing_id()
    placed = settle(rows.orderBy("grp", *order).withColumn("mark", mark), stem).withColumn("part", F.shiftright("mark", ROW_BITS))
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        placed.groupBy("part", "grp")
        .agg(F.count("*").alias("held"), F.min("mark").alias("first"))
        .withColumn("start", F.coalesce(F.sum("held").over(before), F.lit(0)))
        .withColumn("n", F.sum("held").over(Window.partitionBy("grp")))
        .select("part", "grp", "n", (F.col("start") - F.col("first")).alias("shift"))
    )
    return placed.join(runs, ["part", "grp"]).withColumn("index", F.col("mark") + F.col("shift")).drop("mark", "part", "shift")


def _blocks(nodes: DataFrame, carried: Sequence[str], height: int, stem: str) -> DataFrame:
    """One row per aligned block: its nodes in order, with the carried columns."""
    block = F.expr(f"`index` div {ARITY**height}").alias("block")
    held = F.sort_array(F.collect_list(F.struct("index", *carried)))
    return settle(nodes.groupBy("grp", block).agg(held.alias("nodes"), F.max("n").alias("n")), stem)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One block after the other; a block is some hundred kilobytes."""
    for batch in batches:
        for at in range(batch.num_rows):
            yield {name: batch.column(i)[at].as_py() for i, name in enumerate(batch.schema.names)}


def _roots(blocks: DataFrame, height: int) -> DataFrame:
    """The root of each block, as a node of the next tower."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            top = _levels([x["digest"] for x in row["nodes"]], row["n"], height)[-1][0]
            n = -(-row["n"] // ARITY**height)
            yield pa.RecordBatch.from_pydict({"grp": [row["grp"]], "index": [row["block"]], "digest": [top], "n": [n]})

    return blocks.mapInArrow(run, "grp string, index long, digest string, n long")


def _towers(nodes: DataFrame, carried: Sequence[str], height: int, stem: str) -> list[DataFrame]:
    """Blocks of every tower, lowest first; each group has one block in the last."""
    towers = [_blocks(nodes, carried, height, stem)]
    while towers[-1].where(F.col("n") > ARITY**height).take(1):
        towers.append(_blocks(_roots(towers[-1], height), ["digest"], height, stem))
    return towers


PATH = "array<struct<left:string,right:string>>"
PATH_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _way_up(row: dict, levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    return _beside(levels, at) + [(p["left"], p["right"]) for p in row["path"]]


def _handed_down(blocks: DataFrame, height: int) -> DataFrame:
    """For each node of blocks with a ``path`` above them: group, index, subroot and the node's own path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            levels = _levels([x["digest"] for x in row["nodes"]], row["n"], height)
            # A few runs at a time: a path is some thousand characters a level.
            for start in range(0, len(levels[0]), ARITY * ARITY):
                some = range(start, min(start + ARITY * ARITY, len(levels[0])))
                paths = [[{"left": a, "right": b} for a, b in _way_up(row, levels, i)] for i in some]
                columns = [
                    pa.array([row["grp"]] * len(some), pa.string()),
                    pa.array([row["nodes"][i]["index"] for i in some], pa.int64()),
                    pa.array([row["subroot"]] * len(some), pa.string()),
                    pa.array(paths, PATH_TYPE),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["grp", "index", "subroot", "path"])

    asked = blocks.select("grp", "nodes", "n", "path", "subroot")
    return asked.mapInArrow(run, f"grp string, index long, subroot string, path {PATH}")


@dataclass(frozen=True)
class Manifest:
    """``root``: digest over all groups, null of an empty table; ``groups``: group key and
    subroot; ``blocks``: aligned blocks of leaves with subroot and path to the root;
    ``height``: levels of a block."""

    root: str | None
    groups: DataFrame
    blocks: DataFrame
    height: int

    def _per_leaf(self, rows_of, fields: dict[str, str]) -> DataFrame:
        height, leaf = self.height, self.blocks.schema["nodes"].dataType.elementType
        kinds = {"string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "bigint": pa.int64()}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                of_id = batch.schema.field("nodes").type.value_type.field("id").type
                for row in _rows([batch]):
                    levels = _levels([x["digest"] for x in row["nodes"]], row["n"], height)
                    found = [r for at, x in enumerate(row["nodes"]) for r in rows_of(row, x, _way_up(row, levels, at))]
                    columns = zip(*found) if found else [[]] * len(fields)
                    arrays = [pa.array(c, of_id if name == "id" else kinds[kind]) for c, (name, kind) in zip(columns, fields.items())]
                    yield pa.RecordBatch.from_arrays(arrays, list(fields))

        schema = ", ".join(f"{name} {leaf['id'].dataType.simpleString() if name == 'id' else kind}" for name, kind in fields.items())
        return self.blocks.mapInArrow(run, schema)

    def proofs(self) -> DataFrame:
        """Per leaf: its digest, proof and roots, and the root that its version gives.

        ``proof`` is the digest of all siblings on the way up, left to right;
        ``folded_root`` is climbed from the changed leaf, else from the leaf itself.
        """

        root = self.root

        def rows_of(block, leaf, path):
            folded = [leaf["changed"] or leaf["digest"], *_climb(leaf["changed"] or leaf["digest"], path)][-1]
            proof = _hash("".join(a + b for a, b in path))
            yield leaf["id"], leaf["digest"], block["subroot"], root, proof, folded, folded == root

        names = ["leaf", "subroot", "root", "proof", "folded_root"]
        return self._per_leaf(rows_of, {"id": "id"} | {n: "string" for n in names} | {"verified": "boolean"})

    def versions(self) -> DataFrame:
        """The nodes that each changed leaf copies: id, height (0 is the leaf) and digest.

        A node of height h stands for the 16**h aligned leaves about the changed one up
        to the subroot, and for groups above it; all others are shared.
        """

        def rows_of(block, leaf, path):
            if leaf["changed"] is not None:
                group = block["grp"][1:] if block["grp"] else None
                for height, digest in enumerate([leaf["changed"], *_climb(leaf["changed"], path)]):
                    yield group, leaf["id"], leaf["index"], height, digest

        return self._per_leaf(rows_of, {"group": "string", "id": "id", "index": "bigint", "height": "int", "digest": "string"})


def manifest(
    rows: DataFrame,
    *,
    id: str,
    group: str,
    fields: Sequence[str],
    changed: dict[str, Column] | None = None,
    when: Column | None = None,
    height: int = BLOCK_LEVELS,
) -> Manifest:
    """The tree over ``rows``: leaves are digests of ``fields``, by ``group`` and ``id``.

    ``changed`` gives the tampered columns' new values for the rows that ``when`` holds for;
    ``height`` is the number of levels of an aligned block.
    """
    # Groups as keys that are never null, the null group first.
    grp = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    plain = [F.col(f"`{f}`") for f in fields]
    other = [(changed or {}).get(f, F.col(f"`{f}`")) for f in fields]
    tampered = F.when(F.coalesce(when, F.lit(False)), digest_of(other)) if when is not None else F.lit(None).cast("string")
    leaves = rows.select(grp.alias("grp"), F.col(f"`{id}`").alias("id"), digest_of(plain).alias("digest"), tampered.alias("changed"))
    # Sorting samples its input, so the texts are digested and left behind before.
    leaves = settle(leaves, "merkle-leaves")
    placed = _indexed(leaves, [F.asc_nulls_first("id"), F.asc("digest"), F.asc_nulls_first("changed")], "merkle-order")
    towers = _towers(placed, ["digest", "id", "changed"], height, "merkle-blocks")

    # The groups' roots are the leaves of the tree of groups.
    tops = _roots(towers[-1], height).select(F.col("grp").alias("name"), "digest")
    named = settle(_indexed(tops.withColumn("grp", F.lit("")), [F.asc("name")], "merkle-tops"), "merkle-groups")
    upper = _towers(named, ["digest"], height, "merkle-upper")
    top = _roots(upper[-1], height).first()
    tree = _down(upper, upper[-1].select("grp", F.lit("").alias("subroot"), F.expr(f"cast(array() as {PATH})").alias("path")), height)
    groups = named.join(_handed_down(tree, height).drop("subroot"), ["grp", "index"]).select(
        F.col("name").alias("grp"), F.col("digest").alias("subroot"), "path"
    )
    groups = settle(groups, "merkle-paths")
    return Manifest(top and top["digest"], groups.select("grp", "subroot"), _down(towers, groups, height), height)


def _down(towers: list[DataFrame], paths: DataFrame, height: int) -> DataFrame:
    """Blocks of the lowest tower with their paths, from those of the last, which has one block a group."""
    blocks = towers[-1].join(paths, "grp")
    for tower in reversed(towers[:-1]):
        blocks = tower.join(_handed_down(blocks, height).withColumnRenamed("index", "block"), ["grp", "block"])
    return blocks
