"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.llm.tables import labelled_sample
from wardlight.llm.texts import Words, words_of

BUCKETS = 1 << 13
FACTORS = 8
STATS = 16
#: documented bound of the fit: at most so many labelled rows of each class
SAMPLE_PER_CLASS = 3000


@dataclass
class Machine:
    """Score of x: bias + w.x + half the sum over factors of (v.x)^2 - (v^2).(x^2)."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    centre: np.ndarray
    spread: np.ndarray

    def margins(self, row: np.ndarray, feature: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
        """Linear time in the number of non-zero values, by the sum-of-squares identity."""
        out = self.bias + np.bincount(row, self.weights[feature] * value, rows)
        for f in range(self.factors.shape[1]):
            part = self.factors[feature, f] * value
            out += 0.5 * (np.bincount(row, part, rows) ** 2 - np.bincount(row, part * part, rows))
        return out


def _class_table() -> np.ndarray:
    """Kinds of bytes whose shares describe the structure of a text."""
    table = np.full(256, 9, np.int64)  # other symbols
    table[0x41:0x5B] = 0
    table[0x61:0x7B] = 1
    table[0x30:0x3A] = 2
    table[0x80:] = 3
    for kind, chars in ((4, b" \t\r\x0b\x0c"), (5, b"\n"), (6, b".,;:'\"-"), (7, b"!?"), (8, b"|/<>{}[]()=\\_")):
        table[list(chars)] = kind
    return table


_KINDS = _class_table()


def _structure(part: Words, extra: np.ndarray) -> np.ndarray:
    """16 statistics of every text: byte kinds, lengths, repetition and the metadata value."""
    sizes = np.diff(part.offsets)
    text_of_byte = np.repeat(np.arange(part.rows), sizes)
    kinds = np.bincount(text_of_byte * 10 + _KINDS[part.data], minlength=part.rows * 10).reshape(part.rows, 10)
    counts = np.diff(part.bounds)
    out = np.zeros((part.rows, STATS))
    out[:, :10] = np.sqrt(kinds / np.maximum(sizes, 1)[:, None])
    letters = np.bincount(part.row, part.ends - part.starts, part.rows)
    out[:, 10] = letters / np.maximum(counts, 1)
    out[:, 11] = np.log1p(counts)
    out[:, 12] = np.log1p(sizes) - np.log1p(kinds[:, 5])
    out[:, 15] = extra
    return out


def features(part: Words, extra: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, value) of the hashed words and the table of statistics.

    A word's value grows with the logarithm of its count; each text's values have length 1.
    """
    stats = _structure(part, extra)
    key = (part.row.astype(np.uint64) << np.uint64(40)) | (part.hashes >> np.uint64(24))
    key, count = np.unique(key, return_counts=True)
    row = (key >> np.uint64(40)).astype(np.int64)
    bucket = (key & np.uint64(BUCKETS - 1)).astype(np.int64)
    value = 1.0 + np.log(count)
    norm = np.sqrt(np.bincount(row, value * value, part.rows))
    value = value / norm[row]
    distinct = np.bincount(row, minlength=part.rows)
    total = np.maximum(np.diff(part.bounds), 1)
    stats[:, 13] = distinct / total
    most = np.zeros(part.rows)
    np.maximum.at(most, row, count)
    stats[:, 14] = most / total
    return row, bucket, value, stats


def _extra(batch: pa.RecordBatch, column: int) -> np.ndarray:
    values = np.asarray(batch.column(column).cast(pa.float64()).fill_null(0.0))
    return np.log1p(np.maximum(np.nan_to_num(values), 0.0))


def _inputs(documents: DataFrame, metadata: str | None) -> DataFrame:
    meta = F.col(metadata).cast("double") if metadata in documents.columns else F.lit(0.0)
    return documents.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"), meta.alias("extra"))


def fit(
    documents: DataFrame,
    labels: DataFrame,
    held_out: Column,
    label: str = "quality",
    metadata: str | None = "n_chars",
    per_class: int = SAMPLE_PER_CLASS,
    epochs: int = 12,
    seed: int = 7,
) -> Machine:
    """A machine fitted on at most ``2 * per_class`` labelled rows that are not held out.

    Without a usable label, or with one class only, the machine gives the share of label 1 for every text (one half
    if there is none).
    """
    sample, sizes = labelled_sample(labels, label, held_out, per_class)
    total = sum(sizes.values())
    share = (sizes.get(1, 0) + 1.0) / (total + 2.0)
    machine = Machine(
        float(np.log(share / (1 - share))),
        np.zeros(BUCKETS + STATS),
        np.zeros((BUCKETS + STATS, FACTORS)),
        np.zeros(STATS),
        np.ones(STATS),
    )
    if not (sizes.get(0) and sizes.get(1)):
        return machine

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            extra = _extra(batch, 2)
            for part in words_of(batch.column(1), "space", lower=True):
                row, bucket, value, stats = features(part, extra[part.first_row : part.first_row + part.rows])
                at = np.searchsorted(row, np.arange(part.rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first_row, part.rows),
                        batch.column(3).slice(part.first_row, part.rows),
                        pa.ListArray.from_arrays(at, bucket.astype(np.int32)),
                        pa.ListArray.from_arrays(at, value.astype(np.float32)),
                        pa.ListArray.from_arrays(np.arange(part.rows + 1, dtype=np.int32) * STATS, stats.ravel()),
                    ],
                    names=["doc_id", "label", "bucket", "value", "stats"],
                )

    rows = (
        _inputs(documents, metadata)
        .join(F.broadcast(sample), "doc_id")  # at most 2 * per_class ids
        .select("doc_id", "text", "extra", "label")
        .mapInArrow(extract, "doc_id long, label int, bucket array<int>, value array<float>, stats array<double>")
        .toArrow()
        .sort_by("doc_id")
    )
    if rows.num_rows == 0:
        return machine
    y = np.asarray(rows["label"], np.float64)
    stats = np.asarray(rows["stats"].combine_chunks().flatten(), np.float64).reshape(-1, STATS)
    machine.centre, machine.spread = stats.mean(0), stats.std(0) + 1e-6
    stats = np.clip((stats - machine.centre) / machine.spread, -4, 4)
    buckets, values = rows["bucket"].combine_chunks(), rows["value"].combine_chunks()
    at = np.asarray(buckets.offsets) - buckets.offsets[0].as_py()
    bucket, value = np.asarray(buckets.flatten()), np.asarray(values.flatten(), np.float64)
    # the sample holds as many rows of either class; weights restore the shares of all labels
    seen = np.array([(y == 0).sum(), (y == 1).sum()], float)
    weight = np.array([sizes[0], sizes[1]], float) / np.maximum(seen, 1)
    weight = (weight / (weight * seen).sum() * len(y))[y.astype(int)]
    _train(machine, y, weight, at, bucket, value, stats, epochs, seed)
    return machine


def _train(machine, y, weight, at, bucket, value, stats, epochs, seed) -> None:
    """Adam on the weighted logistic loss, in batches of 128 rows."""
    rng = np.random.default_rng(seed)
    size = BUCKETS + STATS
    machine.factors = rng.normal(0, 0.02, (size, FACTORS))
    theta = np.concatenate([machine.weights[:, None], machine.factors], 1)
    first, second, step = np.zeros_like(theta), np.zeros_like(theta), 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for begin in range(0, len(y), 128):
            rows = order[begin : begin + 128]
            x = np.zeros((len(rows), size))
            for i, r in enumerate(rows):
                np.add.at(x[i], bucket[at[r] : at[r + 1]], value[at[r] : at[r + 1]])
            x[:, BUCKETS:] = stats[rows] / 4
            linear = x @ theta
            squared = (x * x) @ (theta[:, 1:] ** 2)
            margin = machine.bias + linear[:, 0] + 0.5 * (linear[:, 1:] ** 2 - squared).sum(1)
            error = weight[rows] * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[rows]) / len(rows)
            grad = np.empty_like(theta)
            grad[:, 0] = x.T @ error
            grad[:, 1:] = x.T @ (linear[:, 1:] * error[:, None]) - theta[:, 1:] * ((x * x).T @ error)[:, None]
            grad += 1e-5 * theta
            step += 1
            first = 0.9 * first + 0.1 * grad
            second = 0.999 * second + 0.001 * grad * grad
            theta -= 0.02 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            machine.bias -= 0.2 * error.sum()
    machine.weights, machine.factors = theta[:, 0].copy(), theta[:, 1:].copy()


def score(documents: DataFrame, machine: Machine, metadata: str | None = "n_chars") -> DataFrame:
    """One row per row of ``documents``: doc_id and the probability of label 1.

    A null text counts as empty; empty texts are scored from their statistics. Every text is read whole. Null ids and
    repeated rows are kept as they are. An empty table gives no rows. Only doc_id, text and the metadata column are
    read, whatever else the table holds; a missing, null or negative metadata value counts as 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            extra = _extra(batch, 2)
            for part in words_of(batch.column(1), "space", lower=True):
                row, bucket, value, stats = features(part, extra[part.first_row : part.first_row + part.rows])
                stats = np.clip((stats - machine.centre) / machine.spread, -4, 4) / 4
                margin = machine.margins(
                    np.concatenate([row, np.repeat(np.arange(part.rows), STATS)]),
                    np.concatenate([bucket, np.tile(np.arange(BUCKETS, BUCKETS + STATS), part.rows)]),
                    np.concatenate([value, stats.ravel()]),
                    part.rows,
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first_row, part.rows).cast(pa.int64()),
                        pa.array(1 / (1 + np.exp(-np.clip(margin, -30, 30)))),
                    ],
                    names=["doc_id", "score"],
                )

    return _inputs(documents, metadata).mapInArrow(run, "doc_id long, score double")
