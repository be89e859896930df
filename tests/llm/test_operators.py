"""Every operator against its brute-force version, on edge cases and on the given tables."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from wardlight.llm import decontaminate, jaccard, licences, line_dedup, packing, queries, secrets, substring, topk


def tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def same(got, want):
    assert Counter(got) == Counter(want)


@pytest.fixture(params=["edge", "crowded", "given"])
def corpus(request, spark, sf_dir, edge_docs, edge_rows, crowded):
    if request.param == "given":
        return tables(spark, sf_dir)
    return (edge_docs if request.param == "edge" else crowded), [r[:2] for r in edge_rows]


def test_substring_dedup(spark, corpus):
    docs, rows = corpus
    out = substring.dedup(spark, docs).collect()
    same([(r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in out], brute.substring_dedup(rows))
    for r in out:
        assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"]


def test_substring_dedup_in_small_blocks(spark, sf_dir):
    docs, rows = tables(spark, sf_dir)
    out = substring.dedup(spark, docs.repartition(7), window=6, anchor=3, block_words=500).collect()
    same(
        [(r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in out], brute.substring_dedup(rows, window=6)
    )


ITEMS = [
    (1, " ".join(f"w{i}" for i in range(3, 20))),
    (2, "W1 w2 w3 w4 w5 w6 w7 w8 w9 w10"),
    (3, "Tiny ITEM"),
    (4, "one"),
    (5, None),
    (6, "..."),
    (None, "été"),
    (10, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10"),
]


def test_contamination(spark, corpus):
    docs, rows = corpus
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, window string")
    for limit in (10, 1000):  # several passes over a benchmark that is too large to broadcast, and one
        out = decontaminate.contamination(spark, docs, items, broadcast_rows=limit).collect()
        same(
            [(r["doc_id"], r["n_words"], r["n_hit"], ",".join(r["items"])) for r in out],
            [(d, n, h, ",".join(i)) for d, n, h, i in brute.contamination(rows, ITEMS)],
        )


def test_contamination_of_given_tables(spark, sf_dir):
    docs, rows = tables(spark, sf_dir)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    want = brute.contamination(rows, [(r["item_id"], r["text"]) for r in items.collect()])
    out = queries.op4_decontamination(spark, sf_dir).collect()
    same(
        [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in out],
        [(d, n, h, len(i), brute.sha(",".join(i)), h > 0) for d, n, h, i in want],
    )


def test_secrets(spark, corpus):
    docs, rows = corpus
    findings, values = secrets.scan(spark, docs)
    out = findings.collect()
    names = ("assign", "access", "hex")
    want = []
    for d, text in rows:
        spans = brute.secrets(text)
        counts = [sum(s[1] == k for s in spans) for k in range(3)]
        want.append((d, *counts, ",".join(f"{names[k]}:{a}:{z}" for a, k, z in spans)))
    same([(r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base"]) for r in out], want)
    for r in out:
        assert set(filter(None, r["base"].split(","))) <= set(filter(None, r["spans"].split(",")))
    assert values.where("owners > 1 and verdict = 'live' and owners >= 3").count() == 0


def test_bare_copies_of_a_credential(spark, edge_docs):
    findings, _ = secrets.scan(spark, edge_docs)
    found = {r["doc_id"]: r["spans"] for r in findings.where("doc_id in (19, 20)").collect()}
    assert found[20] == "assign:0:23"
    assert "bare:" in found[19]


def test_widely_copied_values_are_examples(spark):
    rows = [(i, f"token={'ab12' * 5}", f"s{i}") for i in range(3)] + [(9, f"token={'cd34' * 5}", "s1"), (10, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    findings, values = secrets.scan(spark, docs)
    assert Counter(r["verdict"] for r in values.collect()) == {"example": 1, "live": 1}
    assert {r["doc_id"]: (r["n_live"], r["n_example"]) for r in findings.collect()}[9] == (2, 0)


def test_jaccard(spark, corpus):
    docs, rows = corpus
    out = jaccard.link_components(spark, docs).collect()
    same([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in out], brute.jaccard_components(rows))


def test_jaccard_with_large_hubs(spark, sf_dir):
    """Groups beyond the bound are split into blocks, and blocks joined where that leaves several components."""
    head = [f"h{i}" for i in range(60)]
    rows = [(i, " ".join(head + [f"v{i // 3}_{j}" for j in range(22)] + [f"u{i}"])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = jaccard.link_components(spark, docs, percent=60, group_rows=7).collect()
    want = brute.jaccard_components(rows, percent=60)
    same([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in out], want)


def test_jaccard_of_sets_with_equal_prefixes(spark):
    """Near copies in one block that differ in their last word only: equal sizes, and mostly equal prefixes."""
    rows = []
    for base in range(40):
        text = " ".join(f"b{base}_{i}" for i in range(60))
        rows += [(10 * base + v, f"{text} end{base}_{v}") for v in range(2 + base % 3)]
        rows.append((10 * base + 9, rows[-1][1]))  # an exact copy of the last near copy
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = jaccard.link_components(spark, docs).collect()
    same([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in out], brute.jaccard_components(rows))


def test_top_k(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    got = {tuple(r) for r in topk.top_k(vectors, F.col("vec_id") % 20 == 0, block_rows=64).collect()}
    assert got == brute.top_k(rows, lambda i: i % 20 == 0)


def test_top_k_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -2.0]), (1, [1.0, -2.0]), (2, [-1.0, 0.5]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0])]
    rows += [(6, [1.0, None]), (7, [1.0]), (20, [2.0]), (40, [0.0, 0.0]), (None, [1.0, 1.0]), (8, []), (60, [])]
    rows += [(100 + i, [0.25, -0.5]) for i in range(30)]
    vectors = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    for block_rows in (4, 1000):
        got = {tuple(r) for r in topk.top_k(vectors, F.col("vec_id") % 20 == 0, block_rows=block_rows).collect()}
        assert got == brute.top_k(rows, lambda i: i % 20 == 0)
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_of_many_equal_rows(spark):
    """Repeated candidates rank as often as they occur, and lie in blocks of bounded size."""
    rows = [(1, [2.0])] * 90 + [(2, [1.0])] * 5 + [(20, [1.0]), (3, [3.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(7)
    got = [tuple(r) for r in topk.top_k(vectors, F.col("vec_id") % 20 == 0, block_rows=4).orderBy("rank").collect()]
    assert got == [(20, 1, 3, 3 * 64 * 64)] + [(20, r, 1, 2 * 64 * 64) for r in range(2, 21)]


def test_line_dedup(spark, corpus):
    docs, rows = corpus
    keys = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("k"), "text").collect()
    out = line_dedup.dedup(spark, docs)
    assert set(docs.columns) <= set(out.columns)
    same([(r["doc_id"], r["n_removed"], r["text"]) for r in out.collect()], brute.line_dedup([tuple(r) for r in keys]))


def test_line_dedup_edges(spark):
    long = "x" * 90
    texts = [
        "one two three four\nfive six seven eight\nfirst tail",  # a run of two lines
        "head\none two three four\n\n}\nfive six seven eight\nother tail",  # the same, lines without words between
        "one two three four\nalone", "c\n\n\nd", "z\n}\n}\nw", "c\n\n\nd", "z\n}\n}\nw",
        f"a\n{long}\nb", f"{long}", f"{long}\n{long}",
        "short\nshort\nshort", "x y\nx y\nx y\nx y\nx y\nx y\nx y\nx y",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    out = {r["doc_id"]: r["text"] for r in line_dedup.dedup(spark, docs).collect()}
    assert out[1] == "head\nother tail" and out[2] == "one two three four\nalone"
    assert out[3] == out[5] == "c\n\n\nd" and out[4] == out[6] == "z\n}\n}\nw"
    assert (out[7], out[8], out[9], out[10]) == (f"a\n{long}\nb", "", "", "short\nshort\nshort")
    assert out[11] == "x y"  # runs may overlap the ones before
    want = brute.line_dedup([(d, 0, t) for d, t in enumerate(texts)])
    assert out == {d: t for d, _, t in want}


@pytest.mark.parametrize("run_words", [1, 8, 13])
def test_line_dedup_finds_every_repeated_run(spark, run_words):
    """Runs of 1 to 10 lines of any length that other documents hold too, with common short lines around them."""
    rng, rows = random.Random(5), []
    shared = [" ".join(["s"] * rng.choice([1, 1, 2, 3, 9, 14])) + f" {i}" for i in range(30)]
    common = ["", "}", "ok", "the end", "---"]
    for d in range(70):
        lines = [rng.choice([f"u{d} {i}", rng.choice(common), f"own line {i} of {d} with several more words"]) for i in range(20)]
        for _ in range(3):
            at, start, n = rng.randrange(18), rng.randrange(20), rng.randrange(1, 11)
            lines[at:at] = shared[start : start + n]
        rows.append((d, "\n".join(lines)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = line_dedup.dedup(spark, docs, run_words).collect()
    same(
        [(r["doc_id"], r["n_removed"], r["text"]) for r in out],
        brute.line_dedup([(d, 0, t) for d, t in rows], run_words),
    )


def test_equal_windows_have_equal_fingerprints(spark):
    """Any run of enough words holds a window whose fingerprint does not depend on the lines around the run."""
    run = "alpha beta\n\ngamma delta epsilon\nzeta\neta theta iota kappa"
    texts = [(0, f"p q\n{run}\nr s t"), (1, f"other lines\n}}\n{run}"), (2, run)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = docs.select("doc_id", F.explode(line_dedup.windows(F.col("text"), 8)).alias("w")).select("doc_id", "w.*").collect()
    prints = [{(bytes(r["print"]), bytes(r["run"])) for r in rows if r["doc_id"] == d} for d in range(3)]
    assert prints[2] and prints[2] <= prints[0] & prints[1]


def test_line_dedup_keeps_columns_of_any_name(spark):
    names = "own_key run_doc run_key deleted print at run start end first last runs row_key n_lines n_removed w lines".split()
    rows = [(1, "a b c d e f g h", *names), (2, "a b c d e f g h\nz", *names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    out = line_dedup.dedup(spark, docs).orderBy("doc_id").collect()
    assert [(r["text"], r["n_lines"], r["n_removed"]) for r in out] == [("a b c d e f g h", 1, 0), ("z", 2, 1)]
    assert all(r[n] == n for r in out for n in names if n not in ("n_lines", "n_removed"))


def test_packing(spark, corpus):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs, rows = corpus
    path = public_tokenizers.path("byte_bpe_50k.json")
    exact = Tokenizer.from_file(path)
    want = [
        (d, *p) for d, t in rows for p in brute.pieces(lambda s: exact.encode(s, add_special_tokens=False).ids, t, 512)
    ]
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    for parts, group_rows, fast in ((1, 50_000, ranks), (9, 4, None)):
        out = packing.pack(spark, docs.repartition(parts), path, fast, capacity=512, group_rows=group_rows).collect()
        same([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out], want)
        bins = defaultdict(list)
        for r in out:
            bins[r["sequence_id"]].append((r["offset"], r["length"]))
        for parts_of in bins.values():
            end = 0
            for offset, length in sorted(parts_of):
                assert offset == end
                end += length
            assert end <= 512


def test_packing_is_close_to_the_least_number_of_sequences(spark, sf_dir):
    out = queries.op3_best_fit_packing(spark, sf_dir)
    row = out.agg(F.sum("length").alias("n"), F.count_distinct("sequence_id").alias("s")).first()
    assert row["s"] <= 1.05 * row["n"] / 2048 + 1


def test_packing_keeps_the_ids_of_special_tokens(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path, ranks = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> é", "<|endoftex|>", "plain"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    exact = Tokenizer.from_file(path)
    assert 50256 in exact.encode(texts[0], add_special_tokens=False).ids
    want = [(d, *p) for d, t in enumerate(texts) for p in brute.pieces(lambda s: exact.encode(s, add_special_tokens=False).ids, t)]
    for fast in (ranks, None):
        out = packing.pack(spark, docs, path, fast).collect()
        same([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out], want)


@pytest.mark.parametrize("layout", ["random", "sorted"])
def test_sequences_are_few_however_the_table_is_laid_out(spark, layout):
    """Pieces of 50 to 1900 tokens in 20 deals: long ones must meet the short ones that fill their gaps."""
    import public_tokenizers

    rng = random.Random(3)
    sizes = [rng.randrange(1100, 1900) if rng.random() < 0.3 else rng.randrange(50, 600) for _ in range(8000)]
    if layout == "sorted":
        sizes.sort()
    rows = [(d, " the" * (n - 1)) for d, n in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(8)
    out = packing.pack(
        spark, docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        group_rows=400,
    )
    row = out.agg(F.sum("length").alias("n"), F.count_distinct("sequence_id").alias("s")).first()
    assert row["n"] == sum(sizes)
    assert row["s"] <= 1.01 * -(-row["n"] // 2048)


def test_licences(spark, corpus):
    docs, rows = corpus
    out = licences.scan(docs, licences.known_licences(spark))
    assert out.count() == len(rows)
    found = {r["doc_id"]: (r["state"], r["text_licence"], r["licences"], r["n_notices"]) for r in out.collect()}
    if 21 in found and len(rows) < 100:
        assert found[21] == ("whole", "MIT", "MIT", 1)
        assert found[22] == ("notice", None, "CC-BY-NC-4.0,MIT", 2)
        assert found[5] == ("none", None, "", 0)
    table = licences.scan(docs, licences.known_licences(spark), broadcast_rows=0)
    assert sorted(map(str, table.collect())) == sorted(map(str, out.collect()))


def test_whole_licences_in_other_spellings(spark):
    text = licences.MIT.replace("sublicense", "sub-licence").replace("\n", "\r\n").upper()
    docs = spark.createDataFrame([(1, f"Copyright 1999 A. Person\n{text}")], "doc_id long, text string")
    assert licences.scan(docs, licences.known_licences(spark)).first()["text_licence"] == "MIT"


def test_empty_tables(spark, sf_dir, no_docs):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    path = __import__("public_tokenizers").path("byte_bpe_50k.json")
    assert substring.dedup(spark, no_docs).count() == 0
    assert decontaminate.contamination(spark, no_docs, items).count() == 0
    assert secrets.scan(spark, no_docs)[0].count() == 0
    assert jaccard.link_components(spark, no_docs).count() == 0
    assert line_dedup.dedup(spark, no_docs).count() == 0
    assert packing.pack(spark, no_docs, path).count() == 0
    assert licences.scan(no_docs, licences.known_licences(spark)).count() == 0


def test_empty_benchmark(spark, edge_docs, edge_rows):
    items = spark.createDataFrame([], "item_id long, text string")
    out = decontaminate.contamination(spark, edge_docs, items).collect()
    assert len(out) == len(edge_rows) and not any(r["n_hit"] for r in out)


def test_held_out_rule(spark, sf_dir):
    out = queries.op9_toxicity(spark, sf_dir).select("doc_id", "held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
