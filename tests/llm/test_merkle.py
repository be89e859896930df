"""Merkle manifest against a tree built level by level."""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlight.llm import merkle
from wardlight.llm.tables import remainder


def h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_of(row, extra=0) -> str:
    values = dict(row.asDict() if hasattr(row, "asDict") else row)
    if values["n_chars"] is not None:
        values["n_chars"] += extra
    parts = ("-" if values[f] is None else f"{len(str(values[f]).encode())}:{values[f]}" for f in merkle.FIELDS)
    return h("".join(parts))


def levels_of(leaves: list[str]) -> list[list[str]]:
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels


def siblings(levels, i):
    """(sibling or None, whether it stands on the left) on every level."""
    out = []
    for level in levels[:-1]:
        out.append((level[i ^ 1] if i ^ 1 < len(level) else None, bool(i & 1)))
        i >>= 1
    return out


def brute(rows, tampered):
    trees: dict = {}
    for row in rows:
        trees.setdefault(row["lang"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, leaf_of(row), row))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    levels = {x: levels_of([t[2] for t in sorted(trees[x], key=lambda t: t[:3])]) for x in langs}
    top = levels_of([levels[x][-1][0] for x in langs])
    out = []
    for k, x in enumerate(langs):
        for i, (_, _, leaf, row) in enumerate(sorted(trees[x], key=lambda t: t[:3])):
            steps = siblings(levels[x], i) + siblings(top, k)
            proof = h("".join(s for s, _ in steps if s))
            digest = leaf_of(row, 1) if tampered(row["doc_id"]) else leaf
            for sibling, left in steps:
                digest = h(digest if sibling is None else sibling + digest if left else digest + sibling)
            root = top[-1][0]
            out.append((row["doc_id"], leaf, levels[x][-1][0], root, proof, digest, digest == root))
    return out


def found(frame):
    proof = F.sha2(F.lower(F.hex("siblings")), 256).alias("proof_sha256")
    columns = ("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")
    return [tuple(r) for r in frame.select(*columns).collect()]


def crc_tampered(doc_id) -> bool:
    import zlib

    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0


def tampered():
    return remainder(F.col("doc_id"), 7) == 0


def same(spark, docs, height):
    got = found(merkle.manifest(spark, docs, tampered(), height))
    rows = docs.select(*merkle.FIELDS).collect()
    assert sorted(got, key=repr) == sorted(brute(rows, crc_tampered), key=repr)


@pytest.mark.parametrize("height", [3, 12])
def test_tables(spark, sf_dir, height):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    same(spark, docs, height)


def test_edge_rows(spark, edge_docs, crowded, no_docs):
    height = 2
    same(spark, edge_docs, height)
    langs = F.when(F.col("doc_id") % 3 == 0, None).when(F.col("doc_id") % 3 == 1, "").otherwise(F.col("text"))
    same(spark, edge_docs.withColumn("lang", langs), height)
    same(spark, edge_docs.withColumns({"n_chars": F.lit(None).cast("long"), "source": F.lit(None).cast("string")}), height)
    same(spark, crowded, height)
    same(spark, no_docs, height)
    same(spark, edge_docs.where("doc_id = 5"), height)


def test_clashing_names(spark, edge_docs):
    names = "tree row digest tampered number pos total part at block store root path rows count subroot whole".split()
    same(spark, edge_docs.selectExpr("*", *[f"'x' AS {n}" for n in names]), 2)


@pytest.mark.parametrize("total", [1, 2, 5, 17])
def test_one_language_of_any_size(spark, total):
    docs = spark.range(total).selectExpr("id AS doc_id", "'s' AS source", "'x' AS lang", "1L AS n_chars", "'t' AS text")
    same(spark, docs, 2)


def test_block_is_in_van_emde_boas_order():
    assert merkle.addresses(2)[1:].tolist() == [0, 1, 2]
    # the root's half first, then each lower subtree by itself
    assert merkle.addresses(4)[1:].tolist() == [0, 1, 2, 3, 6, 9, 12, 4, 5, 7, 8, 10, 11, 13, 14]
    for levels in range(1, 14):
        assert sorted(merkle.addresses(levels)[1:].tolist()) == list(range((1 << levels) - 1))


def test_aligned_subtrees_are_contiguous():
    place = merkle.addresses(8)
    for root in range(16, 32):  # the lower four levels
        nodes = [v for d in range(4) for v in range(root << d, (root + 1) << d)]
        assert np.ptp(place[nodes]) == len(nodes) - 1


def test_hot_language_is_cut_into_blocks(spark):
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "'s' AS source", "if(id % 10 = 0, 'b', 'a') AS lang", "id AS n_chars", "'same' AS text"
    )
    placed = merkle.positions(spark, docs.selectExpr("lang AS tree", "doc_id"), ["doc_id"], "test")
    rows = placed.selectExpr("*", "unhex(sha2(string(doc_id), 256)) AS digest", "doc_id AS row", "cast(null AS binary) AS tampered")
    forest = merkle.build_forest(spark, rows, 4, "test")
    assert len(forest.tiers) == 3
    assert forest.tiers[0].agg(F.max("count")).first()[0] == 16
    assert forest.roots().count() == 2
