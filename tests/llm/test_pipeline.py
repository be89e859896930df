"""The stages of the pipeline: each against brute force on its own input, then as a whole."""

from __future__ import annotations

from collections import Counter

import brute
import corpus_pipeline as pipeline
from pyspark.sql import functions as F



def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [name for name, _ in pipeline.STAGES][:1] == ["toxicity"] and 4 <= len(pipeline.STAGES) <= 5
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        if k < len(pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            left = [(r["doc_id"], r["text"]) for r in out.collect()]
        if name == "line_dedup":
            keyed = [tuple(r) for r in docs.select("doc_id", F.xxhash64("doc_id", "text"), "text").collect()]
            want = brute.line_dedup(keyed)
            assert Counter(left) == Counter((d, t) for d, _, t in want)
            assert out.where(F.length("text") != F.col("n_chars")).isEmpty()
        elif name == "ngram_jaccard":
            keyed = [tuple(r) for r in docs.select("doc_id", F.xxhash64("doc_id", "text"), "text").collect()]
            assert Counter(left) == Counter(kept_of_similar(keyed))
        elif name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            clean = {d for d, _, hit, _ in brute.contamination(rows, items) if not hit}
            assert Counter(left) == Counter(r for r in rows if r[0] in clean)
        elif name == "best_fit_packing":
            assert {r["doc_id"] for r in out.collect()} == {d for d, _ in rows}
        docs = out


def kept_of_similar(keyed):
    """One document of each group, by all pairs of sets."""
    rows = sorted(set(keyed), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    sets = [brute.shingle_set(t) for _, _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                group[b] = a
    kept = {rows[i] for i in range(len(rows)) if root(i) == i}
    return [(d, t) for d, k, t in keyed if (d, k, t) in kept]


def test_rows_of_one_id_are_told_apart(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (1, text), (3, text + " more"), (3, "of another kind altogether and like no other text"), (None, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [tuple(r) for r in pipeline.keep_one_of_similar(spark, docs, "").collect()]
    assert Counter(left) == Counter([rows[0], rows[1], rows[3]])


def test_stages_on_edge_rows(spark, sf_dir, edge_docs, no_docs):
    """What every stage leaves of rows with nulls, empty and long texts, repeats and ties."""
    kept = Counter()
    for docs in (edge_docs, no_docs):
        before = docs
        for name, stage in pipeline.STAGES:
            out = stage(spark, before, sf_dir).cache()
            assert out.columns == before.columns or name == "best_fit_packing"
            ids = Counter(r["doc_id"] for r in before.select("doc_id").collect())
            left = Counter(r["doc_id"] for r in out.select("doc_id").collect())
            assert set(left) <= set(ids)
            if name in ("line_dedup", "best_fit_packing"):
                assert set(left) == set(ids)
            if name == "ngram_jaccard" and docs is edge_docs:
                # texts without words stay, and so do those that lost all lines
                assert {4, 5, 6} <= set(left) and left.total() < ids.total()
            if name == "decontamination" and docs is edge_docs:
                kept = left
            before = out
        if docs is edge_docs:
            assert kept
            assert out.where("length > 2048 or offset + length > 2048").isEmpty()
        else:
            assert out.isEmpty()


def test_stages_keep_columns_of_any_name(spark, sf_dir):
    names = "gone gone_doc gone_key f_key f_doc _wl_key _wl_row own_key run_doc row_key key deleted score label".split()
    rows = [(d, f"text number {d} of a few words", "en", "s", 1, *names) for d in range(4)]
    ddl = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    docs = spark.createDataFrame(rows, ddl)
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *names]
    out = docs.collect()
    assert len(out) == 4 and all(r[n] == n for r in out for n in names)


def test_run(spark, sf_dir):
    out = pipeline.run(spark, sf_dir)
    assert out.agg(F.count_distinct("doc_id")).first()[0] > 0
