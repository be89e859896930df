"""Classifiers: held-out accuracy, exactness of the machine and of the index, edge cases."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlight.llm import quality, toxicity
from wardlight.llm.tables import remainder

SF = "/root/testdata/sf0.01"


def held_out_scores(spark, module, label, modulus, rest):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = remainder(F.col("doc_id"), modulus) == rest
    scores = module.score(docs, module.fit(docs, labels, held))
    rows = scores.join(labels, "doc_id").where(held).select("score", label).collect()
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows])


def test_quality_on_held_out_rows(spark):
    score, label = held_out_scores(spark, quality, "quality", 3, 1)
    assert ((score >= 0.5) == label).mean() > 0.95


def test_toxicity_on_held_out_rows(spark):
    score, label = held_out_scores(spark, toxicity, "toxic", 5, 0)
    assert ((score >= 0.5) == label).mean() > 0.85
    assert ((score >= 0.5) & (label == 0)).sum() <= 0.05 * (label == 0).sum()


def test_factorisation_machine_equals_the_sum_over_pairs():
    rng = np.random.default_rng(3)
    size = 12
    machine = quality.Machine(
        0.3, rng.normal(size=size), rng.normal(size=(size, 4)), np.zeros(quality.STATS), np.ones(quality.STATS)
    )
    x = rng.normal(size=size)
    pairs = sum(
        machine.factors[i] @ machine.factors[j] * x[i] * x[j] for i in range(size) for j in range(i + 1, size)
    )
    margin = machine.margins(np.zeros(size, np.int64), np.arange(size), x, 1)[0]
    assert margin == pytest.approx(0.3 + machine.weights @ x + pairs)


def test_nearest_equals_all_cosines():
    rng = np.random.default_rng(4)
    examples, terms = 300, 40
    dense = np.where(rng.random((examples, terms)) < 0.15, rng.integers(1, 5, (examples, terms)), 0)
    row, term = np.nonzero(dense)
    idf = rng.uniform(0.5, 4, terms)
    index = toxicity._index(
        np.arange(terms, dtype=np.uint64), idf, np.arange(examples), np.zeros(examples), np.ones(examples),
        term, row, dense[row, term], 0.1,
    )
    weights = np.where(dense > 0, (1 + np.log(np.maximum(dense, 1))) * idf, 0)
    norms = np.maximum(np.sqrt((weights**2).sum(1)), 1e-12)
    for _ in range(50):
        mine = np.flatnonzero(rng.random(terms) < 0.2)
        if not len(mine):
            continue
        vector = toxicity._vector(mine, rng.integers(1, 4, len(mine)), idf)
        cosine = weights[:, mine] @ vector / norms
        want = np.lexsort((np.arange(examples), -np.round(cosine, 12)))[:7]
        found, near = index.nearest(mine, vector, 7)
        assert found.tolist() == want[cosine[want] > 0].tolist()
        assert near == pytest.approx(cosine[found])


def test_only_near_copies_of_one_class_count_once():
    """Unrelated examples count even if all hold the common term of the smallest hash; copies count once in a class."""
    rng = np.random.default_rng(6)
    own = [np.unique(rng.integers(10**6, 2**63, 60, np.uint64)) for _ in range(40)]
    sets = [np.concatenate([np.array([1, 2, 3], np.uint64), x]) for x in own]
    copies = [np.sort(np.append(x[:-2], np.uint64(2**63 + i))) for i, x in enumerate(sets[:10])]
    examples = sets + copies + sets[10:20] + [np.zeros(0, np.uint64)] * 2
    y = np.array([i % 2 for i in range(40)] + [i % 2 for i in range(10)] + [1 - i % 2 for i in range(10)] + [0, 1], float)
    row = np.repeat(np.arange(len(examples)), [len(x) for x in examples])
    counted = toxicity._without_near_copies(np.concatenate(examples), row, y)
    assert counted.tolist() == [True] * 40 + [False] * 10 + [True] * 12


def test_terms_of_unrelated_examples_are_selected():
    """A toxic term that 20 of 200 examples hold is found, though all examples share the term of the smallest hash."""
    rng = np.random.default_rng(7)
    y = np.array([float(i < 20) for i in range(200)])
    sets = [
        np.unique(np.append(rng.integers(10**6, 2**63, 30, np.uint64), np.array([1, 77] if t else [1], np.uint64)))
        for t in y
    ]
    row = np.repeat(np.arange(200), [len(x) for x in sets])
    kept = toxicity._selected(np.concatenate(sets), row, y, np.ones(200), 10)
    assert 77 in kept.tolist()


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_edge_rows(spark, edge_docs, edge_rows, crowded, no_docs, module, label):
    ddl = f"doc_id long, {label} int, text string"
    none = spark.createDataFrame([], ddl)
    one_class = spark.createDataFrame([(1, 1, "x"), (2, 1, "x"), (None, 0, "x"), (3, None, "x")], ddl)
    both = spark.createDataFrame([(1, 1, "x"), (2, 0, "x"), (2, 0, "x"), (7, 1, "x"), (999, 0, "x")], ddl)
    for docs in (edge_docs, crowded):
        for labels in (none, one_class, both):
            out = module.score(docs, module.fit(docs, labels, F.lit(False))).collect()
            assert len(out) == len(edge_rows)
            assert all(0 <= r["score"] <= 1 for r in out)
    assert module.score(no_docs, module.fit(no_docs, both, F.lit(False))).count() == 0
