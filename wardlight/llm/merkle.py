"""Merkle manifest of a dataset: blocks of nodes in van Emde Boas order, block roots recursing into further tiers.

A tree is cut into aligned subtrees of ``2**height`` leaves. Each is built by one task and stored as one byte array in
van Emde Boas order: the upper half of its levels first, then the lower halves one after the other, each laid out the
same way. The address of a node follows from its level and index alone, both when parents are made from their children
and when the siblings of a leaf are fetched. The roots of the blocks are the leaves of the next tier, until one block is
left; the subroots of all trees form one more such tree.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.llm.tables import written

#: fixed: the fields of a leaf, in the order in which they are hashed
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: levels above the leaves of a block: a block holds at most 4096 leaves
HEIGHT = 12
DIGEST = 32


# --- one block -------------------------------------------------------------------------------------------------------


@cache
def addresses(levels: int) -> np.ndarray:
    """Place of every node of a complete tree of ``levels`` levels in van Emde Boas order.

    Nodes are numbered from the root, 1, downwards: the children of node v are 2 v and 2 v + 1.
    """
    if levels == 1:
        return np.array([-1, 0], np.int64)
    top = levels // 2
    bottom = levels - top
    upper, lower = addresses(top), addresses(bottom)
    place = np.full(1 << levels, -1, np.int64)
    place[1 : 1 << top] = upper[1:]
    bases = (1 << top) - 1 + np.arange(1 << top, dtype=np.int64) * ((1 << bottom) - 1)
    for depth in range(bottom):
        own = lower[1 << depth : 2 << depth]
        place[1 << (top + depth) : 2 << (top + depth)] = (bases[:, None] + own[None, :]).ravel()
    return place


def parent(children: bytes) -> bytes:
    """Digest of a run of one or two nodes, whose digests enter as hexadecimal text."""
    return sha256(children.hex().encode()).digest()


class Block:
    """An aligned subtree: ``count`` leaves under ``height`` levels, nodes in van Emde Boas order in ``store``."""

    def __init__(self, height: int, count: int, store: bytes | bytearray):
        self.height, self.count, self.store = height, count, store
        self.place = addresses(height + 1)

    @classmethod
    def build(cls, height: int, leaves: Sequence[bytes]) -> Block:
        block = cls(height, len(leaves), bytearray(((2 << height) - 1) * DIGEST))
        for i, leaf in enumerate(leaves):
            block._put(0, i, leaf)
        for level in range(1, height + 1):
            below = block.width(level - 1)
            for i in range(block.width(level)):
                run = block.node(level - 1, 2 * i)
                if 2 * i + 1 < below:
                    run += block.node(level - 1, 2 * i + 1)
                block._put(level, i, parent(run))
        return block

    def width(self, level: int) -> int:
        return -(-self.count >> level)

    def _at(self, level: int, i: int) -> int:
        return int(self.place[(1 << (self.height - level)) + i]) * DIGEST

    def _put(self, level: int, i: int, digest: bytes) -> None:
        at = self._at(level, i)
        self.store[at : at + DIGEST] = digest

    def node(self, level: int, i: int) -> bytes:
        at = self._at(level, i)
        return bytes(self.store[at : at + DIGEST])

    def root(self) -> bytes:
        return self.node(self.height, 0)

    def siblings(self, i: int) -> bytes:
        """The siblings on the way from leaf ``i`` to the block's root, one after the other; only those that exist."""
        out = []
        for level in range(self.height):
            if i ^ 1 < self.width(level):
                out.append(self.node(level, i ^ 1))
            i >>= 1
        return b"".join(out)


def block_height(total: int, height: int) -> int:
    """Levels above the leaves of a block of a tree of ``total`` leaves: all, unless the tree is one block."""
    return height if total > 1 << height else (total - 1).bit_length()


def fold(digest: bytes, position: int, total: int, path: bytes) -> tuple[bytes, bytes]:
    """The root above a leaf, from its digest and the siblings in ``path``; and what is left of the path."""
    at = 0
    while total > 1:
        run = digest
        if position ^ 1 < total:
            sibling = path[at : at + DIGEST]
            at += DIGEST
            run = sibling + digest if position & 1 else digest + sibling
        digest = parent(run)
        position, total = position >> 1, (total + 1) >> 1
    return digest, path[at:]


# --- tiers of blocks -------------------------------------------------------------------------------------------------


def leaf_text(columns: dict[str, Column]) -> Column:
    """The text that a leaf is the digest of: of each field ``-`` if null, else its byte count, a colon and its value."""

    def part(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.concat(*[part(columns[name]) for name in FIELDS])


def positions(spark: SparkSession, frame: DataFrame, order: Sequence[str], purpose: str) -> DataFrame:
    """``frame`` with ``pos``, the place of a row in its tree, and ``total``, the rows of the tree.

    Rows are sorted by range over all partitions, so one tree may hold any share of them; each partition numbers the
    rows of its trees, and the numbers of rows in earlier partitions are added.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = frame.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, previous, at = TaskContext.get().partitionId(), (), 0
        for batch in batches:
            places = np.empty(batch.num_rows, np.int64)
            for i, tree in enumerate(batch.column("tree").to_pylist()):
                at = at + 1 if (tree,) == previous else 0
                previous = (tree,)
                places[i] = at
            numbers = pa.array(np.full(batch.num_rows, part, np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, numbers, pa.array(places)], [*columns, "part", "at"])

    ranged = frame.repartitionByRange(parts, "tree", *order).sortWithinPartitions("tree", *order)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)
    numbered = written(spark, ranged.mapInArrow(number, f"{ddl}, part int, at long"), f"{purpose}-numbered")
    counts = numbered.groupBy("tree", "part").agg(F.count("*").alias("n"))
    # of a tree one row for each partition
    sums = counts.selectExpr(
        "tree AS c_tree",
        "part AS c_part",
        "sum(n) OVER (PARTITION BY tree ORDER BY part) - n AS before",
        "sum(n) OVER (PARTITION BY tree) AS total",
    )
    same = F.col("tree").eqNullSafe(F.col("c_tree")) & (F.col("part") == F.col("c_part"))
    return numbered.join(sums, same).select(*columns, (F.col("before") + F.col("at")).alias("pos"), "total")


@dataclass
class Forest:
    """The blocks of every tier, from the leaves upwards: (tree, block, total, store, root, ...), as written tables."""

    tiers: list[DataFrame]
    height: int

    def roots(self) -> DataFrame:
        """(tree, root), one row for each tree."""
        return self.tiers[-1].select("tree", "root")


def build_forest(spark: SparkSession, leaves: DataFrame, height: int, purpose: str) -> Forest:
    """Blocks over ``leaves`` (tree, pos, total, digest, row, tampered) and, tier by tier, over their roots."""
    tree_type = leaves.schema["tree"].dataType.simpleString()
    ddl = (
        f"tree {tree_type}, block long, total long, count int, store binary, root binary, "
        "rows array<bigint>, tampered array<binary>"
    )
    names = ["tree", "block", "total", "count", "store", "root", "rows", "tampered"]

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        total, first = table["total"][0].as_py(), table["pos"][0].as_py()
        block = Block.build(block_height(total, height), table["digest"].to_pylist())
        values = [
            table["tree"][0].as_py(), first >> height, total, block.count, bytes(block.store), block.root(),
            table["row"].to_pylist(), table["tampered"].to_pylist(),
        ]
        kinds = [table.schema.field("tree").type, pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        kinds += [pa.list_(pa.int64()), pa.list_(pa.binary())]
        return pa.table([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

    tiers: list[DataFrame] = []
    nodes = leaves.select("tree", "pos", "total", "digest", "row", "tampered")
    while True:
        blocks = nodes.groupBy("tree", F.shiftright("pos", height).alias("block")).applyInArrow(build, ddl)
        tiers.append(written(spark, blocks, f"{purpose}-tier"))
        above = F.shiftright(F.col("total") + (1 << height) - 1, height)
        if not tiers[-1].agg(F.max(above) > 1).first()[0]:
            return Forest(tiers, height)
        nodes = tiers[-1].select(
            "tree",
            F.col("block").alias("pos"),
            above.alias("total"),
            F.col("root").alias("digest"),
            F.lit(None).cast("long").alias("row"),
            F.lit(None).cast("binary").alias("tampered"),
        )


def _with_paths(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """Blocks with the siblings above their root: ``paths`` has (tree, pos, path) for each block, however many."""
    paths = paths.select(F.col("tree").alias("p_tree"), F.col("pos").alias("p_pos"), "path")
    same = F.col("tree").eqNullSafe(F.col("p_tree")) & (F.col("block") == F.col("p_pos"))
    return blocks.join(paths, same).drop("p_tree", "p_pos")


def child_paths(blocks: DataFrame, height: int) -> DataFrame:
    """(tree, pos, path): the siblings above every leaf of ``blocks``, which have the siblings above their root."""
    tree_type = blocks.schema["tree"].dataType.simpleString()

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("tree").type
            for b in batch.to_pylist():
                block = Block(block_height(b["total"], height), b["count"], b["store"])
                rows = range(b["count"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([b["tree"]] * b["count"], kind),
                        pa.array([(b["block"] << height) + i for i in rows], pa.int64()),
                        pa.array([block.siblings(i) + b["path"] for i in rows], pa.binary()),
                    ],
                    ["tree", "pos", "path"],
                )

    rows = blocks.select("tree", "block", "total", "count", "store", "path")
    return rows.mapInArrow(spread, f"tree {tree_type}, pos long, path binary")


def block_paths(forest: Forest, above: DataFrame) -> DataFrame:
    """The lowest blocks with ``path``, the siblings above their root; ``above`` has (tree, path) for each tree."""
    tier = len(forest.tiers) - 1
    paths = above.select("tree", F.lit(0).cast("long").alias("pos"), "path")
    while tier:
        paths = child_paths(_with_paths(forest.tiers[tier], paths), forest.height)
        tier -= 1
    return _with_paths(forest.tiers[0], paths)


def _single_tree(spark: SparkSession, rows: DataFrame, purpose: str) -> DataFrame:
    """Subroots (key, digest) as the leaves of one tree in the order of the key, null first."""
    leaves = rows.select(F.lit(0).alias("tree"), "key", "digest")
    return written(spark, positions(spark, leaves, ["key"], purpose), purpose)


# --- manifest --------------------------------------------------------------------------------------------------------


def manifest(spark: SparkSession, documents: DataFrame, tampered: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """One row for each row of ``documents``: its leaf, the roots above it, its proof, and whether it verifies.

    A leaf is the digest of the row's ``FIELDS``. The leaves of a language are the leaves of one tree in the order of
    doc_id, and its root, the subroot, is a leaf of the tree over all languages, in bytewise order, null first. A parent
    is the digest of its one or two children; a lone leaf is its own root. Columns: doc_id, lang, leaf, subroot, root
    (hexadecimal), position and total (place and size in the language's tree), siblings (binary, 32 bytes each, from the
    leaf upwards, those that exist), folded_root (from the leaf and its siblings) and verified (folded_root is root).

    Where ``tampered`` holds, the leaf that is folded, and only that, is made from n_chars + 1; null or false leave it
    as it is, and so does a null n_chars. Null ids come first. Rows of equal id are ordered by their leaf, and rows that
    are alike in all fields in any order: they have equal leaves, so the roots do not depend on it, and their proofs
    are those of different places. Columns other than ``FIELDS`` are ignored, whatever their name. No rows give none.

    No task holds more than ``2**height`` leaves, whatever share of the rows one language has.
    """
    own = {name: F.col(name) for name in FIELDS}
    changed = {**own, "n_chars": F.col("n_chars") + 1}
    is_changed = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))

    def digest(columns: dict[str, Column]) -> Column:
        return F.unhex(F.sha2(leaf_text(columns), 256))

    # the number of the row is fixed by writing it; it parts rows that are alike, so that a range can be cut there
    leaves = written(
        spark,
        documents.select(
            F.col("lang").alias("tree"),
            F.col("doc_id").cast("long").alias("row"),
            digest(own).alias("digest"),
            F.when(is_changed & F.col("n_chars").isNotNull(), digest(changed)).alias("tampered"),
            F.monotonically_increasing_id().alias("number"),
        ),
        "merkle-leaves",
    )
    placed = positions(spark, leaves, ["row", "digest", "number"], "merkle")
    forest = build_forest(spark, placed, height, "merkle")

    subroots = forest.roots().select(F.col("tree").alias("key"), F.col("root").alias("digest"))
    langs = _single_tree(spark, subroots, "merkle-langs")
    top = build_forest(
        spark,
        langs.withColumns({"row": F.lit(None).cast("long"), "tampered": F.lit(None).cast("binary")}),
        height,
        "merkle-top",
    )
    empty = top.roots().select("tree", F.lit(b"").alias("path"))
    over = child_paths(block_paths(top, empty), height).select(F.col("pos").alias("o_pos"), "path")
    above = langs.join(over, F.col("pos") == F.col("o_pos")).select(
        F.col("key").alias("tree"), "path", "pos", "total", F.col("digest").alias("subroot")
    )
    # the same for every language, so it travels with the languages
    root = top.roots().select(F.col("root").alias("whole"))
    above = written(spark, above.join(root, F.lit(True)), "merkle-above")
    lowest = block_paths(forest, above).join(
        above.select(
            F.col("tree").alias("a_tree"), F.col("pos").alias("lang_pos"), F.col("total").alias("langs"),
            "subroot", "whole",
        ),
        F.col("tree").eqNullSafe(F.col("a_tree")),
    )
    return lowest.drop("a_tree", "root").mapInArrow(
        _proofs(height),
        "doc_id long, lang string, leaf string, subroot string, root string, position long, total long, "
        "siblings binary, folded_root string, verified boolean",
    )


def _proofs(height: int):
    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                yield _block_proofs(b, height)

    return prove


def _block_proofs(b: dict, height: int) -> pa.RecordBatch:
    """Proofs of all leaves of one block."""
    block = Block(block_height(b["total"], height), b["count"], b["store"])
    root, subroot, path = b["whole"], b["subroot"].hex(), b["path"]
    blocks = -(-b["total"] >> height)
    folded_above: dict[bytes, bytes] = {}

    def to_root(digest: bytes) -> bytes:
        """From the block's root on; copies of a digest lead to the same root."""
        if digest not in folded_above:
            top, rest = fold(digest, b["block"], blocks, path)
            folded_above[digest] = fold(top, b["lang_pos"], b["langs"], rest)[0]
        return folded_above[digest]

    rows: list[tuple] = []
    for i, (doc_id, tampered) in enumerate(zip(b["rows"], b["tampered"], strict=True)):
        leaf, own = block.node(0, i), block.siblings(i)
        digest = leaf if tampered is None else tampered
        at, k = i, 0
        for level in range(block.height):
            run = digest
            if at ^ 1 < block.width(level):
                sibling = own[k : k + DIGEST]
                k += DIGEST
                run = sibling + digest if at & 1 else digest + sibling
            digest = parent(run)
            at >>= 1
        folded = to_root(digest)
        position = (b["block"] << height) + i
        rows.append(
            (doc_id, b["tree"], leaf.hex(), subroot, root.hex(), position, b["total"], own + path, folded.hex(),
             folded == root)
        )
    kinds = [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.bool_()]
    names = "doc_id lang leaf subroot root position total siblings folded_root verified".split()
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
    )
