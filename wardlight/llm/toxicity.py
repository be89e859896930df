"""Toxicity: nearest labelled examples by exact TF-IDF cosine over block-max inverted indexes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.llm.tables import labelled_sample
from wardlight.llm.texts import words_of

#: documented bounds of the fit: labelled examples of each class, and terms of the index
EXAMPLES_PER_CLASS = 2000
MAX_TERMS = 1024
#: a term is indexed from this chi-squared against the label, and this share of label 1 among its documents
MIN_CHI2 = 30.0
MIN_SHARE = 0.8
#: bytes of the word beginnings that are terms beside the whole words, as languages inflect
BEGINNINGS = (4, 5, 6, 7, 8, 9)
#: examples of one class whose terms are that similar (Jaccard) count once when terms are selected
NEAR_COPY = 0.8
#: MinHash bands that find them, and values of a band
BANDS, BAND = 10, 4
BLOCK = 64
NEIGHBOURS = 16
#: weight of the prior among the votes
PRIOR_WEIGHT = 0.25


@dataclass
class BlockMaxIndex:
    """Postings of every term in example order, cut into blocks of examples, with the largest weight in each block."""

    terms: np.ndarray  # sorted hashes
    idf: np.ndarray
    example_ids: np.ndarray
    labels: np.ndarray
    votes: np.ndarray  # weight of an example's vote, so that the sample's classes stand for all labels
    starts: np.ndarray  # [term, block]: first posting of the term in the block
    posting: np.ndarray  # example within its block
    weight: np.ndarray
    block_max: np.ndarray  # [term, block]
    prior: float

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Examples and cosines of the k nearest with a cosine above 0; ties go to the earlier example.

        Blocks are read by falling upper bound; a block whose bound cannot beat the kth cosine ends the search.
        """
        bounds = weights @ self.block_max[terms]
        best, found = np.zeros(0), np.zeros(0, np.int64)
        for b in np.argsort(-bounds, kind="stable"):
            if bounds[b] <= 0 or (len(best) >= k and bounds[b] * (1 + 1e-9) < best[k - 1]):
                break
            acc = np.zeros(BLOCK)
            for t, w in zip(terms, weights, strict=True):
                a, z = self.starts[t, b], self.starts[t, b + 1]
                acc[self.posting[a:z]] += w * self.weight[a:z]
            hit = np.flatnonzero(acc > 0)
            best, found = np.concatenate([best, acc[hit]]), np.concatenate([found, b * BLOCK + hit])
            keep = np.lexsort((found, -np.round(best, 12)))[:k]
            best, found = best[keep], found[keep]
        return found, best

    def vote(self, found: np.ndarray, cosine: np.ndarray) -> float:
        weight = cosine * self.votes[found]
        return float((weight @ self.labels[found] + PRIOR_WEIGHT * self.prior) / (weight.sum() + PRIOR_WEIGHT))


class Vocabulary:
    """Sorted term hashes with a bitmap in front, as nearly all words of a text are no terms."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(terms & np.uint64(0xFFFF)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are terms, and the terms' places."""
        if not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hit = np.flatnonzero(self.maybe[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.terms, hashes[hit]), len(self.terms) - 1)
        same = self.terms[place] == hashes[hit]
        return hit[same], place[same]


def _counts(
    column: pa.Array, vocabulary: Vocabulary | None
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of texts: first row, rows, then text, term and count of each distinct term of a text.

    Terms are hashes, or places in the vocabulary if there is one, which leaves all other terms out.
    """
    for part in words_of(column, "symbol", lower=True):
        terms, rows = [], []
        for hashes, which in ((part.hashes, None), *(part.prefixes(n) for n in BEGINNINGS)):
            row = part.row if which is None else part.row[which]
            if vocabulary is None:
                terms.append(hashes)
                rows.append(row)
            else:
                hit, place = vocabulary.find(hashes)
                terms.append(place)
                rows.append(row[hit])
        term, row = np.concatenate(terms), np.concatenate(rows)
        order = np.lexsort((term, row))
        term, row = term[order], row[order]
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (row[1:] != row[:-1])
        at = np.flatnonzero(new)
        yield part.first_row, part.rows, row[at], term[at], np.diff(at, append=len(term))


def _vector(terms: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weight = (1 + np.log(count)) * idf[terms]
    return weight / np.sqrt(weight @ weight)


def fit(
    documents: DataFrame,
    labels: DataFrame,
    held_out: Column,
    label: str = "toxic",
    per_class: int = EXAMPLES_PER_CLASS,
    max_terms: int = MAX_TERMS,
) -> BlockMaxIndex:
    """An index of at most ``2 * per_class`` labelled examples that are not held out.

    Terms are lower-cased words between ASCII symbols, and word beginnings, that go with label 1: at most ``max_terms``,
    by chi-squared in the sample weighted to all labels, where near copies of one example of the same class count once. The document
    frequencies behind the IDF come from all documents. With one class only, or no term, every text gets the share of
    label 1 (0.5 if there is no label).
    """
    sample, sizes = labelled_sample(labels, label, held_out, per_class)
    prior = (sizes.get(1, 0) + 0.5) / (sum(sizes.values()) + 1.0)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows, row, term, count in _counts(batch.column(1), None):
                at = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, rows),
                        batch.column(2).slice(first, rows),
                        pa.ListArray.from_arrays(at, term.view(np.int64)),
                        pa.ListArray.from_arrays(at, count.astype(np.int32)),
                    ],
                    names=["doc_id", "label", "terms", "counts"],
                )

    examples = (
        documents.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
        .join(F.broadcast(sample), "doc_id")  # at most 2 * per_class ids
        .select("doc_id", "text", "label")
        .mapInArrow(extract, "doc_id long, label int, terms array<long>, counts array<int>")
        .toArrow()
        .sort_by("doc_id")
    )
    ids = np.asarray(examples["doc_id"], np.int64)
    y = np.asarray(examples["label"], np.float64)
    lists = examples["terms"].combine_chunks()
    at = np.asarray(lists.offsets, np.int64) - (lists.offsets[0].as_py() if len(lists.offsets) else 0)
    term = np.asarray(lists.flatten(), np.int64).view(np.uint64)
    count = np.asarray(examples["counts"].combine_chunks().flatten(), np.int64)
    row = np.repeat(np.arange(len(ids)), np.diff(at)) if len(ids) else np.zeros(0, np.int64)
    seen = np.array([(y == 0).sum(), (y == 1).sum()], float)
    votes = np.array([sizes.get(0, 0), sizes.get(1, 0)], float) / np.maximum(seen, 1)
    votes = (votes / max(votes.max(), 1e-9))[y.astype(int)]
    kept = _selected(term, row, y, votes, max_terms)
    documents_of = _document_frequencies(documents, kept)
    total = float(documents_of[-1])
    idf = np.log((1 + total) / (1 + documents_of[:-1])) + 0.1
    place = np.minimum(np.searchsorted(kept, term), max(len(kept) - 1, 0))
    hit = kept[place] == term if len(kept) else np.zeros(len(term), bool)
    return _index(kept, idf, ids, y, votes, place[hit], row[hit], count[hit], prior)


def _selected(term: np.ndarray, row: np.ndarray, y: np.ndarray, votes: np.ndarray, most: int) -> np.ndarray:
    if not len(term) or y.min() == y.max():
        return np.zeros(0, np.uint64)
    counted = _without_near_copies(term, row, y)  # of near copies of one class only the first counts
    votes = votes * counted
    values, place = np.unique(term, return_inverse=True)
    scale = counted.sum() / votes.sum()
    with_term = [np.bincount(place, votes[row] * scale * (y[row] == c), len(values)) for c in (0, 1)]
    totals = [votes[y == c].sum() * scale for c in (0, 1)]
    n, have = sum(totals), with_term[0] + with_term[1]
    cross = with_term[1] * (totals[0] - with_term[0]) - with_term[0] * (totals[1] - with_term[1])
    chi2 = n * cross**2 / np.maximum(have * (n - have) * totals[0] * totals[1], 1e-9)
    chi2[(with_term[1] < MIN_SHARE * have) | (have <= 0)] = 0
    order = np.lexsort((values, -chi2))[:most]
    return np.sort(values[order[chi2[order] >= MIN_CHI2]])


def _without_near_copies(term: np.ndarray, row: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which examples count: those that are no near copy of an earlier one of their class that counts.

    ``term``, ``row``: each example's distinct terms, examples in order. Candidates share a band of MinHash values and
    are compared by the exact Jaccard similarity of their terms.
    """
    counted = np.ones(len(y), bool)
    at = np.searchsorted(row, np.arange(len(y) + 1))
    filled = np.flatnonzero(np.diff(at))
    least = np.empty((len(filled), BANDS * BAND), np.uint64)
    for k in range(BANDS * BAND):
        mixed = (term ^ (np.uint64(k + 1) * np.uint64(0x9E3779B97F4A7C15 >> 8))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        least[:, k] = np.minimum.reduceat(mixed ^ (mixed >> np.uint64(29)), at[filled]) if len(filled) else 0
    held: dict[tuple[int, float, bytes], list[int]] = {}
    for i, values in zip(filled.tolist(), least, strict=True):
        own = term[at[i] : at[i + 1]]
        bands = [(b, y[i], values[b * BAND : (b + 1) * BAND].tobytes()) for b in range(BANDS)]
        for j in sorted({j for band in bands for j in held.get(band, ())}):
            other = term[at[j] : at[j + 1]]
            common = len(np.intersect1d(own, other, assume_unique=True))
            if common >= NEAR_COPY * (len(own) + len(other) - common):
                counted[i] = False
                break
        else:
            for band in bands:
                held.setdefault(band, []).append(i)
    return counted


def _document_frequencies(documents: DataFrame, terms: np.ndarray) -> np.ndarray:
    """Documents with each term and, last, all documents: counted over the whole table, summed per task first."""
    size, vocabulary = len(terms), Vocabulary(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size + 1, np.int64)
        for batch in batches:
            held[-1] += batch.num_rows
            for _, _, _, term, _ in _counts(batch.column(0), vocabulary):
                held[:-1] += np.bincount(term, minlength=size) if size else 0
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 1)), pa.array(held)], names=["place", "n"])

    counted = documents.select(F.col("text").alias("text")).mapInArrow(count, "place long, n long")
    out = np.zeros(size + 1, np.int64)
    for place, n in counted.groupBy("place").agg(F.sum("n").alias("n")).collect():  # max_terms + 1 rows at most
        out[place] = n
    return out


def _index(terms, idf, ids, y, votes, term, row, count, prior) -> BlockMaxIndex:
    order = np.lexsort((term, row))
    term, row, count = term[order], row[order], count[order]
    weight = (1 + np.log(count)) * idf[term] if len(term) else np.zeros(0)
    norm = np.sqrt(np.bincount(row, weight * weight, len(ids)))
    weight = weight / norm[row] if len(term) else weight
    blocks = -(-len(ids) // BLOCK)
    order = np.lexsort((row, term))
    term, row, weight = term[order], row[order], weight[order]
    key = term * (blocks + 1) + row // BLOCK
    starts = np.searchsorted(key, np.arange(len(terms) * (blocks + 1))).reshape(len(terms), blocks + 1)
    block_max = np.zeros((len(terms), max(blocks, 1)))
    np.maximum.at(block_max, (term, row // BLOCK), weight)
    return BlockMaxIndex(terms, idf, ids, y, votes, starts, row % BLOCK, weight, block_max, prior)


def _scores(column: pa.Array, index: BlockMaxIndex, neighbours: int) -> Iterator[tuple[int, int, tuple[np.ndarray, ...]]]:
    """For slices of texts: first row, rows, and of each text the score, the nearest example (-1: none), its cosine."""
    known: dict[bytes, tuple[float, int, float]] = {}
    for first, rows, row, term, count in _counts(column, Vocabulary(index.terms)):
        scores = np.full(rows, index.prior)
        nearest, cosine = np.full(rows, -1, np.int64), np.zeros(rows)
        at = np.searchsorted(row, np.arange(rows + 1))
        for i in np.unique(row):
            part = slice(at[i], at[i + 1])
            key = term[part].tobytes() + count[part].tobytes()
            if key not in known:
                found, near = index.nearest(term[part], _vector(term[part], count[part], index.idf), neighbours)
                known[key] = (
                    index.vote(found, near),
                    int(index.example_ids[found[0]]) if len(found) else -1,
                    float(near[0]) if len(found) else 0.0,
                )
            scores[i], nearest[i], cosine[i] = known[key]
        yield first, rows, (scores, nearest, cosine)


def score(documents: DataFrame, index: BlockMaxIndex, neighbours: int = NEIGHBOURS) -> DataFrame:
    """One row per row of ``documents``: doc_id, score and the nearest example behind it as evidence.

    The score is the vote of the ``neighbours`` nearest examples, weighted by cosine, with the share of label 1 as
    prior; a text without an indexed term, an empty or a null text gets the prior. evidence_id and evidence_cosine
    name the nearest example (null without one). Null ids and repeated rows are kept; an empty table gives no rows;
    other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows, (scores, nearest, cosine) in _scores(batch.column(1), index, neighbours):
                none = nearest < 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, rows).cast(pa.int64()),
                        pa.array(scores),
                        pa.array(nearest, mask=none),
                        pa.array(cosine, mask=none),
                    ],
                    names=["doc_id", "score", "evidence_id", "evidence_cosine"],
                )

    return documents.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text")).mapInArrow(
        run, "doc_id long, score double, evidence_id long, evidence_cosine double"
    )


def keep_below(
    documents: DataFrame, index: BlockMaxIndex, limit: float, neighbours: int = NEIGHBOURS
) -> DataFrame:
    """The rows of ``documents``, with all their columns, whose score is below ``limit``; nothing is shuffled."""
    place = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows, (scores, _, _) in _scores(batch.column(place), index, neighbours):
                yield batch.slice(first, rows).filter(pa.array(scores < limit))

    return documents.mapInArrow(run, documents.schema)
