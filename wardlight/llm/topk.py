"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 4096
TIER = 256
RESULT = "query_id long, rank int, vec_id long, score long"


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """floor(scale * x) of every component; vectors that are null or hold null or non-finite components are left out."""
    fine = F.col(vector_col).isNotNull() & ~F.exists(
        vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    return vectors.where(fine & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"),
    )


def _pack(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row per block and dimension count: ids and the row-major matrix, as bytes."""
    for batch in batches:
        block = np.asarray(batch.column(0))
        ids = np.asarray(batch.column(1))
        dims = np.diff(np.asarray(batch.column(2).offsets))
        for dim in np.unique(dims):
            for one in np.unique(block[dims == dim]):
                rows = np.flatnonzero((dims == dim) & (block == one))
                matrix = batch.column(2).take(pa.array(rows)).flatten()
                matrix = np.asarray(matrix, np.int64).reshape(len(rows), dim)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([one], pa.int64()),
                        pa.array([dim], pa.int32()),
                        pa.array([ids[rows].astype(np.int64).tobytes()], pa.binary()),
                        pa.array([matrix.tobytes()], pa.binary()),
                    ],
                    schema=schema,
                )


_BLOCK = pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()), ("matrix", pa.binary())])
_BLOCK_DDL = "block long, dim int, ids binary, matrix binary"


def blocks(vectors: DataFrame, count: int) -> DataFrame:
    """Rows gathered into ``count`` blocks by a hash of their contents, so a repeated task deals them alike."""
    dealt = vectors.select(F.pmod(F.xxhash64("id", "v"), F.lit(count)).alias("block"), "id", "v")
    return dealt.repartition("block").mapInArrow(lambda b: _pack(_regroup(b), _BLOCK), _BLOCK_DDL)


def _regroup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches of about a block, so that a block is not cut where a batch happens to end."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= 4 * BLOCK_ROWS:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


class SortedLists:
    """The sorted list of every dimension of one block of vectors.

    The lists are read from both ends, as a query's component may be negative. ``tiers`` holds the vectors in the order
    in which reading all lists one step further each time comes across them; ``top`` and ``bottom`` hold the values at
    every depth, from which a query's threshold at that depth follows.
    """

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        order = np.argsort(matrix, axis=0, kind="stable")
        n, dim = matrix.shape
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(n)[:, None].repeat(dim, 1), 0)
        depth = np.minimum(rank, n - 1 - rank).min(1) if dim else np.zeros(n, np.int64)
        by_depth = np.lexsort((ids, depth))
        ordered = np.take_along_axis(matrix, order, 0)
        self.depth, self.ids, self.matrix = depth[by_depth], ids[by_depth], matrix[by_depth]
        self.top, self.bottom = ordered[::-1], ordered

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best (query row, id, score) of the block; ties go to the smaller id, a query's own id is left out."""
        exact = _exact_type(self.matrix, queries)
        best_score = np.full((len(ids), k), np.iinfo(np.int64).min)
        best_id = np.full((len(ids), k), np.iinfo(np.int64).max)
        filled = np.zeros(len(ids), np.int64)
        active = np.arange(len(ids))
        positive, negative = np.maximum(queries, 0).astype(exact), np.minimum(queries, 0).astype(exact)
        for first in range(0, len(self.ids), TIER):
            rows = slice(first, first + TIER)
            scores = (queries[active].astype(exact) @ self.matrix[rows].T.astype(exact)).astype(np.int64)
            tier_ids = np.broadcast_to(self.ids[rows], scores.shape)
            own = tier_ids == ids[active, None]
            all_scores = np.concatenate([best_score[active], scores], 1)
            all_ids = np.concatenate([best_id[active], tier_ids], 1)
            missing = np.concatenate([np.arange(k)[None] >= np.minimum(filled[active], k)[:, None], own], 1)
            all_scores = np.where(missing, np.iinfo(np.int64).min, all_scores)
            all_ids = np.where(missing, np.iinfo(np.int64).max, all_ids)
            keep = np.lexsort((all_ids, ~all_scores), axis=1)[:, :k]
            best_score[active] = np.take_along_axis(all_scores, keep, 1)
            best_id[active] = np.take_along_axis(all_ids, keep, 1)
            filled[active] += (~own).sum(1)
            if first + TIER < len(self.ids):
                # every vector not yet seen lies at this depth or deeper in all lists
                depth = int(self.depth[first + TIER])
                bound = positive[active] @ self.top[depth].astype(exact) + negative[active] @ self.bottom[depth].astype(exact)
                active = active[(filled[active] < k) | (bound >= best_score[active, -1])]
                if not len(active):
                    break
        row, place = np.nonzero(np.arange(k)[None] < np.minimum(filled, k)[:, None])
        return row, best_id[row, place], best_score[row, place]


def _exact_type(a: np.ndarray, b: np.ndarray) -> type:
    """float64 where it holds every partial sum exactly, else int64."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    return np.float64 if largest < 2**52 else np.int64


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``k`` rows with the largest integer inner product for every query row, among all rows but its own id.

    Candidates lie in blocks of about ``block_rows`` rows, queries in blocks of the same size; a block's lists are
    sorted in the task that meets a query block. The threshold algorithm reads all lists of a block in step and stops
    for a query as soon as no unseen row can reach its kth score. The best k of each block are then ranked per query.

    Vectors that are null, or hold null or non-finite components, and rows with a null id take no part. Vectors of
    different lengths are never compared. Scores are exact while they fit 64 bits. Repeated rows are ranked as often
    as they occur as candidates; a repeated query id is answered once if its rows are equal. Fewer than k other rows:
    all of them. An empty table gives no rows. Other columns, whatever their names, are not read.
    """
    ready = quantised(vectors, id_col, vector_col, scale)
    asked = quantised(vectors.where(is_query), id_col, vector_col, scale).distinct()
    sizes = ready.agg(F.count("*").alias("n")).crossJoin(asked.agg(F.count("*").alias("q"))).first()
    n_blocks, q_blocks = (max(1, -(-sizes[c] // block_rows)) for c in ("n", "q"))
    # of rows that are alike no answer has more than k, so a block holds no more of them
    copies = ready.groupBy("id", "v").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("n"))
    kept = copies.select("id", "v", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("col")
    candidates = blocks(kept, n_blocks)
    queries = (
        blocks(asked, q_blocks)
        .select(F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"), "dim")
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    )
    pairs = candidates.join(queries, ["block", "dim"]).select("dim", "ids", "matrix", "q_ids", "q_matrix")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[bytes, SortedLists] | None = None
        for batch in batches:
            for dim, ids, matrix, q_ids, q_matrix in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if last is None or last[0] != ids:
                    own = np.frombuffer(ids, np.int64)
                    last = ids, SortedLists(own, np.frombuffer(matrix, np.int64).reshape(len(own), dim))
                asked_ids = np.frombuffer(q_ids, np.int64)
                asked_rows = np.frombuffer(q_matrix, np.int64).reshape(len(asked_ids), dim)
                for first in range(0, len(asked_ids), 512):
                    part = slice(first, first + 512)
                    row, found, score = last[1].search(asked_ids[part], asked_rows[part], k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(asked_ids[part][row]), pa.array(found), pa.array(score)],
                        names=["query_id", "vec_id", "score"],
                    )

    found = pairs.mapInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
