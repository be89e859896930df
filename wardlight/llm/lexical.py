"""Ranked lexical search by classes of documents that are the same bag of item terms.

Documents are cut down to the terms of the items. Those with the same terms, counts and length norm have the same score
for every item, so they are one class: found by a hash, told apart by the vectors themselves, and scored once. The
documents of the best classes are then listed in the order of their ids.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardlight.llm import texts
from wardlight.llm.tables import written

#: fixed: a term, after A-Z were lower-cased
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: bytes of text and number of items of one block; a block's vocabulary travels to the tasks
BLOCK_BYTES, BLOCK_ITEMS = 16_000_000, 20_000
#: classes that a task scores together
SCORED_ROWS = 4096
LAST = 2**63 - 1


def terms_of(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(LOWER))


@dataclass
class Vocabulary:
    """The terms of a block of items: hashes in ascending order, the bytes of each term, and the items by term number."""

    hashes: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    data: np.ndarray
    items: list[tuple[np.ndarray, np.ndarray]]  # terms and how often the item holds them

    @classmethod
    def of(cls, items: list[str]) -> Vocabulary:
        bags = [Counter(terms_of(text)) for text in items]
        terms = sorted({term for bag in bags for term in bag})
        column = pa.array(terms, pa.string())
        hashes = [words.hashes for words in texts.words_of(column, "symbol", False)] if terms else []
        hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        if len(np.unique(hashes)) != len(terms):
            raise ValueError("two terms of the items have the same hash")
        order = np.argsort(hashes)
        raw = [terms[i].encode() for i in order.tolist()]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        number = {terms[i]: k for k, i in enumerate(order.tolist())}
        pairs = []
        for bag in bags:
            own = sorted((number[term], times) for term, times in bag.items())
            pairs.append((np.array([t for t, _ in own], np.int64), np.array([q for _, q in own], np.int64)))
        starts = np.cumsum(lengths) - lengths
        return cls(hashes[order], starts, lengths, np.frombuffer(b"".join(raw), np.uint8), pairs)

    def numbers(self, words: texts.Words) -> tuple[np.ndarray, np.ndarray]:
        """The words that are terms, and the terms' numbers; the bytes are compared, not only the hashes."""
        if not len(self.hashes) or not len(words.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, words.hashes), len(self.hashes) - 1)
        sizes = words.ends - words.starts
        found = np.flatnonzero((self.hashes[at] == words.hashes) & (self.lengths[at] == sizes))
        term, size = at[found], sizes[found]
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        equal = (
            words.data[np.repeat(words.starts[found], size) + step] == self.data[np.repeat(self.starts[term], size) + step]
        )
        if not equal.all():
            same = np.logical_and.reduceat(equal, np.cumsum(size) - size)
            found, term = found[same], term[same]
        return found, term


def _vectors(vocabulary: Vocabulary):
    """Length n and the vector of item terms, numbers and counts as 32-bit integers, of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = max(len(vocabulary.hashes), 1)
        for batch in batches:
            lengths, vectors = [], []
            for words in texts.words_of(batch.column(1), "symbol", True):
                found, term = vocabulary.numbers(words)
                keys, counts = np.unique(words.row[found] * width + term, return_counts=True)
                row, term = keys // width, (keys % width).astype("<i4")
                bounds = np.searchsorted(row, np.arange(words.rows + 1)).tolist()
                counts = counts.astype("<i4")
                vectors += [term[a:z].tobytes() + counts[a:z].tobytes() for a, z in zip(bounds, bounds[1:], strict=False)]
                lengths.append(np.diff(words.bounds))
            n = np.concatenate(lengths) if lengths else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(vectors, pa.binary())], ["doc_id", "n", "vector"]
            )

    return run


def _frequencies(width: int):
    """(term, df): how many of a task's documents hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(width, np.int64)
        for batch in batches:
            parts = [v[: len(v) // 2] for v in batch.column(0).to_pylist()]
            held += np.bincount(np.frombuffer(b"".join(parts), "<i4"), minlength=width)
        terms = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int64()), pa.array(held[terms], pa.int64())], ["term", "df"])

    return run


class _Best:
    """The best classes so far for each item: by score, then by the smallest id of the class."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [
            (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object)) for _ in range(items)
        ]

    def offer(self, item: int, scores: np.ndarray, first: np.ndarray, key: np.ndarray) -> None:
        held = self.rows[item]
        least = held[0][-1] if len(held[0]) == self.k else 1
        if len(scores) > self.k:
            least = max(least, np.partition(scores, -self.k)[-self.k])
        new = np.flatnonzero(scores >= least)
        if len(new):
            merged = [np.concatenate([a, b[new]]) for a, b in zip(held, (scores, first, key), strict=True)]
            order = np.lexsort((merged[1], -merged[0]))[: self.k]
            self.rows[item] = (merged[0][order], merged[1][order], merged[2][order])


def _scores(vocabulary: Vocabulary, weights: np.ndarray, k: int):
    """(item, score, first, key): the best ``k`` classes of a task for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(vocabulary.items), k)
        for batch in batches:
            for at in range(0, batch.num_rows, SCORED_ROWS):
                _score_batch(batch.slice(at, SCORED_ROWS), vocabulary, weights, best)
        item = np.concatenate([np.full(len(r[0]), i) for i, r in enumerate(best.rows)] or [np.zeros(0)])
        columns = [np.concatenate([r[c] for r in best.rows]) if best.rows else np.zeros(0, np.int64) for c in range(3)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(item.astype(np.int64)),
                pa.array(columns[0], pa.int64()),
                pa.array(columns[1], pa.int64()),
                pa.array(columns[2].tolist(), pa.binary()),
            ],
            ["item", "score", "first", "key"],
        )

    return run


def _score_batch(batch: pa.RecordBatch, vocabulary: Vocabulary, weights: np.ndarray, best: _Best) -> None:
    key = np.array(batch.column(0).to_pylist(), object)
    vectors = batch.column(1).to_pylist()
    m = batch.column(2).to_numpy().astype(np.int64)
    first = batch.column(3).to_numpy().astype(np.int64)
    sizes = np.fromiter((len(v) // 8 for v in vectors), np.int64, len(vectors))
    term = np.frombuffer(b"".join(v[: len(v) // 2] for v in vectors), "<i4").astype(np.int64)
    tf = np.frombuffer(b"".join(v[len(v) // 2 :] for v in vectors), "<i4").astype(np.int64)
    row = np.repeat(np.arange(len(vectors)), sizes)
    value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
    order = np.argsort(term, kind="stable")
    row, value = row[order], value[order]
    bounds = np.searchsorted(term[order], np.arange(len(vocabulary.hashes) + 1))
    for item, (terms, times) in enumerate(vocabulary.items):
        total = np.zeros(len(vectors), np.int64)
        for t, q in zip(terms.tolist(), times.tolist(), strict=True):
            a, z = bounds[t], bounds[t + 1]
            total[row[a:z]] += q * value[a:z]  # a class holds a term once
        best.offer(item, total, first, key)


def _ranked(
    spark: SparkSession, documents: DataFrame, items: list[tuple], k: int, id_type: str
) -> DataFrame | None:
    """(item, rank, doc_id, score) of one block of items; None if no document holds any of their terms."""
    vocabulary = Vocabulary.of([text for _, text in items])
    width = len(vocabulary.hashes)
    bags = written(
        spark,
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(
            _vectors(vocabulary), "doc_id long, n long, vector binary"
        ),
        "bags",
    )
    n_docs, n_terms = bags.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = bags.where(F.length("vector") > 0)
    held = (
        holding.select("vector").mapInArrow(_frequencies(width), "term long, df long").groupBy("term").agg(F.sum("df"))
    ).collect()  # one row for each term of the block
    if not held:
        return None
    weights = np.zeros(width, np.int64)
    for term, df in held:
        weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    m = (F.lit(100 - 75) + F.expr(f"(75L * n * {n_docs}L) div {n_terms}L")).alias("m")
    vectors = holding.select("doc_id", "vector", m).withColumn(
        "key", F.unhex(F.sha2(F.concat("vector", F.encode(F.col("m").cast("string"), "UTF-8")), 256))
    )
    # grouping compares the vectors as well as their digests
    classes = vectors.groupBy("key", "vector", "m").agg(F.min(F.coalesce("doc_id", F.lit(LAST))).alias("first"))
    scored = classes.select("key", "vector", "m", "first").mapInArrow(
        _scores(vocabulary, weights, k), "item long, score long, first long, key binary"
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"), "first", "key")
    best = written(spark, scored.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k), "best-classes")
    # at most k keys of 32 bytes for each item of a block, whose number is bounded
    keys = best.select(F.col("key").alias("b_key")).distinct()
    members = vectors.select("doc_id", "key").join(F.broadcast(keys), F.col("key") == F.col("b_key"), "left_semi")
    by_id = Window.partitionBy("key").orderBy(F.asc_nulls_last("doc_id"))
    members = members.withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= k).drop("r")
    rank = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    expanded = best.select("item", "score", F.col("key").alias("b_key")).join(members, F.col("key") == F.col("b_key"))
    ranked = expanded.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(items)], f"i long, item_id {id_type}")
    return ranked.join(names, F.col("item") == F.col("i")).select("item_id", "rank", "doc_id", "score")


def search(spark: SparkSession, documents: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank (int, from 1), doc_id, score (long, above 0).

    Terms are runs of ASCII digits and letters, A-Z lower-cased, and of all other characters beyond ASCII. N counts the
    documents with a term, L their terms, n a document's, df the documents holding a term, tf its occurrences. The
    weight w of a term is floor(1000 ln((2 N + 2) / (2 df + 1))), a document's norm m is 25 + (75 n N) div L, and its
    score the sum over the item's terms, repeats included, of w ((10**9 tf) div (1000 tf + 8 m)).

    Equal scores rank by ascending doc_id, null last. A null or empty text has no term: such a document ranks nowhere,
    such an item gets no row. Repeated rows of documents are documents of their own and each takes a rank; repeated rows
    of items count once, and items of one id but different texts are ranked apart. Other columns are not read, whatever
    their name. Without documents or items there are no rows.

    Items are taken in blocks of at most ``BLOCK_ITEMS`` items and about ``BLOCK_BYTES`` of text; each block reads the
    documents once. A block travels to the tasks; documents and classes never reach the driver.
    """
    known = items.select(F.col("item_id").alias("item_id"), F.col("text").alias("text")).distinct()
    id_type = known.schema["item_id"].dataType.simpleString()
    known = known.where(F.length("text") > 0)
    count, size = known.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(-(-count // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    out = spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")
    for number in range(blocks):
        rows = known.where(block == number).collect()
        ranked = _ranked(spark, documents, [(row[0], row[1]) for row in rows], k, id_type) if rows else None
        if ranked is not None:
            out = out.unionByName(ranked)
    return out
