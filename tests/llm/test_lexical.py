"""Ranked lexical search against the score's definition, document by document."""

from __future__ import annotations

import math
from collections import Counter

import pytest

from wardlight.llm import lexical


def brute(rows: list[tuple], items: list[tuple], k: int = 10) -> list[tuple]:
    bags = [(doc_id, Counter(lexical.terms_of(text))) for doc_id, text in rows]
    total, docs = sum(sum(b.values()) for _, b in bags), sum(bool(b) for _, b in bags)
    df = Counter(term for _, b in bags for term in b)
    out = []
    for item_id, text in set(items):
        found = []
        for doc_id, bag in bags:
            n, score = sum(bag.values()), 0
            for term in lexical.terms_of(text):
                if bag[term]:
                    m = 100 - 75 + (75 * n * docs) // total
                    w = math.floor(1000 * math.log((2 * docs + 2) / (2 * df[term] + 1)))
                    score += w * ((1000000000 * bag[term]) // (1000 * bag[term] + 8 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        found.sort(key=lambda f: f[:3])
        out += [(item_id, rank + 1, f[3], -f[0]) for rank, f in enumerate(found[:k])]
    return out


def same(spark, docs, items, k=10):
    got = [tuple(r) for r in lexical.search(spark, docs, items, k).collect()]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = brute(rows, [(r["item_id"], r["text"]) for r in items.collect()], k)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return got


@pytest.fixture(scope="module")
def edge_items(spark):
    rows = [
        ("a", "w1 w2 w3 w3 W39"), ("b", None), ("c", ""), ("d", "!!! ..."), ("e", "no such term anywhere zzz"),
        ("f", "été l2 l3 tiny item"), ("f", "l996 l1"), ("g", "w1"), ("g", "w1"), (None, "one two a a a"),
        ("h", "24be64439e3e49cf46b2d7c90f3602a3d0b907ff MIT licence"),
    ]
    return spark.createDataFrame(rows, "item_id string, text string")


def test_tables(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    got = same(spark, docs, items)
    assert len(got) > 100


def test_edge_rows(spark, edge_docs, crowded, edge_items, no_docs):
    assert same(spark, edge_docs, edge_items)
    assert sorted(map(repr, same(spark, crowded, edge_items))) == sorted(map(repr, same(spark, edge_docs, edge_items)))
    assert not same(spark, no_docs, edge_items)
    assert not same(spark, edge_docs, edge_items.limit(0))


def test_crowded_items(spark, edge_docs, edge_items):
    names = "doc_id rank score item key vector m n term i first b_key r".split()
    crowded = edge_items.selectExpr("*", *[f"'x' AS {n}" for n in names])
    assert same(spark, edge_docs, crowded)


def test_ties_and_copies(spark):
    """Hundreds of copies and texts that differ only beyond the items' terms: one class each, ranked by id."""
    rows = [(1000 - i, "apple pear filler" if i % 3 else f"apple pear other{i}") for i in range(600)]
    rows += [(None, "apple pear filler"), (7, "apple pear filler"), (7, "apple pear filler"), (5000, "apple apple")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([("q", "apple pear"), ("r", "apple"), ("s", "filler")], "item_id string, text string")
    got = same(spark, docs, items)
    assert [r[2] for r in sorted(got) if r[0] == "q"][:2] == [7, 7]
    same(spark, docs, items, k=3)


def test_blocks_of_items(spark, sf_dir, monkeypatch):
    """Several blocks give what one gives."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 15)
    monkeypatch.setattr(lexical, "SCORED_ROWS", 7)
    same(spark, docs, items)


def test_equal_hashes_are_told_apart(monkeypatch):
    """Words that share a term's hash and length but not its bytes are not the term."""
    import numpy as np
    import pyarrow as pa

    vocabulary = lexical.Vocabulary.of(["apple"])
    words = next(lexical.texts.words_of(pa.array(["apple grape"]), "symbol", True))
    words.hashes = np.repeat(vocabulary.hashes, 2)
    found, _ = vocabulary.numbers(words)
    assert found.tolist() == [0]
