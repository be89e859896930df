"""Substring dedup: word k-mers as edges of a De Bruijn graph, repeated paths compacted and verified at their source.

Two exchanges find the repeated edges without moving all of them:

1. Every window of ``window`` words has an anchor, the smallest hash among its shorter shingles. Equal windows have
   equal anchors, so only anchors that several documents hold can belong to repeated windows.
2. Windows with such an anchor are the edges that are exchanged, by the hash of their anchor, which keeps neighbours
   together. Each edge learns its first document, in the order of ids, and its place there: its source coordinate.

Consecutive edges whose source coordinates advance together form a path without branches; where a node branches, the
next edge's first source lies elsewhere and the path ends. Runs of edges found in different tasks are put together into
whole paths, joined with their source document and with their own, and removed only if both texts have the same words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlight.llm.exchange import PACKED_DDL, Entries, bucket_count, bucket_of, packed, unpacked
from wardlight.llm.texts import Words, words_of

WINDOW = 13
ANCHOR = 7
#: words of the documents that a task sorts at once
BLOCK_WORDS = 2_000_000

RUN_DDL = "key long, start int, size int, src_key long, src_start int"


def _anchors(part: Words, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window inside one text: its first word, its anchor's first word and hash."""
    starts = part.shingles(window)[1]
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    short = part.rolled(anchor)
    best, at = short[starts].copy(), starts.copy()
    for j in range(1, window - anchor + 1):
        other = short[starts + j]
        less = other < best
        best[less] = other[less]
        at[less] = starts[less] + j
    return starts, at, best


class _Block:
    """Entries of several slices of documents, numbered in the order of (id, key) so that the smallest comes first."""

    def __init__(self) -> None:
        self.ids: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.docs = 0
        self.size = 0

    def add(self, ids: np.ndarray, keys: np.ndarray, row: np.ndarray, *values: np.ndarray) -> None:
        self.ids.append(ids)
        self.keys.append(keys)
        self.parts.append((row + self.docs, *values))
        self.docs += len(ids)
        self.size += len(row)

    def take(self) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        ids, keys = np.concatenate(self.ids), np.concatenate(self.keys)
        order = np.lexsort((keys, ids))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        columns = [np.concatenate(c) for c in zip(*self.parts, strict=True)]
        columns[0] = rank[columns[0]]
        self.__init__()
        return ids[order], keys[order], columns


def _repeated(hashes: np.ndarray, doc: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by hash and document, group of each place in that order, whether the group has several ids)."""
    order = np.lexsort((doc, hashes))
    h, d = hashes[order], ids[doc[order]]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    group = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(h)) - 1
    return order, group, d[first] != d[last] if len(first) else np.zeros(0, bool)


def _send_anchors(buckets: int, window: int, anchor: int, block_words: int):
    def finish(block: _Block) -> Iterator[pa.RecordBatch]:
        ids, keys, (doc, at, hashes) = block.take()
        order, group, several = _repeated(hashes, doc, ids)
        entries = Entries(ids, keys, doc[order], hashes[order], at[order])
        here = several[group] if len(group) else np.zeros(0, bool)
        # an anchor of several documents of the block is settled for them; one entry tells the other blocks
        first = np.ones(len(group), bool)
        first[1:] = group[1:] != group[:-1]
        for part, kind in ((entries.select(~here | first), 0), (entries.select(here), 1)):
            if len(part.doc):
                by_doc = np.lexsort((part.places, part.doc))
                part = part.select(by_doc)
                spread = part.hashes if kind == 0 else part.keys[part.doc].view(np.uint64)
                yield packed(part, bucket_of(spread, buckets), kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches:
            ids, keys = np.asarray(batch.column(0), np.int64), np.asarray(batch.column(1), np.int64)
            for part in words_of(batch.column(2), "space", lower=False):
                rows = slice(part.first_row, part.first_row + part.rows)
                _, at, hashes = _anchors(part, window, anchor)
                place, which = np.unique(at, return_index=True)
                row = part.row[place]
                block.add(ids[rows], keys[rows], row, place - part.bounds[row], hashes[which])
                if block.size >= block_words // 4:
                    yield from finish(block)
        if block.size:
            yield from finish(block)

    return run


def _shared_anchors(table: pa.Table) -> pa.Table:
    """(key, place) of the anchors that several documents hold."""
    settled = unpacked(table.filter(pc.equal(table["kind"], 1)))
    entries = unpacked(table.filter(pc.equal(table["kind"], 0)))
    order, group, several = _repeated(entries.hashes, _by_id(entries), np.sort(entries.ids))
    hit = order[several[group]] if len(group) else order
    keys = np.concatenate([entries.keys[entries.doc[hit]], settled.keys[settled.doc]])
    places = np.concatenate([entries.places[hit], settled.places])
    return pa.table({"key": pa.array(keys, pa.int64()), "place": pa.array(places.astype(np.int32))})


def _by_id(entries: Entries) -> np.ndarray:
    """For each entry the rank of its document by id."""
    order = np.argsort(entries.ids, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank[entries.doc]


def _runs(key: np.ndarray, start: np.ndarray, src_key: np.ndarray, src_start: np.ndarray) -> pa.Table:
    """Consecutive edges of one document with consecutive sources in one other, as runs."""
    order = np.lexsort((start, key))
    key, start, src_key, src_start = key[order], start[order], src_key[order], src_start[order]
    new = np.ones(len(key), bool)
    new[1:] = (
        (key[1:] != key[:-1])
        | (start[1:] != start[:-1] + 1)
        | (src_key[1:] != src_key[:-1])
        | (src_start[1:] != src_start[:-1] + 1)
    )
    at = np.flatnonzero(new)
    return pa.table(
        {
            "key": pa.array(key[at], pa.int64()),
            "start": pa.array(start[at].astype(np.int32)),
            "size": pa.array(np.diff(at, append=len(key)).astype(np.int32)),
            "src_key": pa.array(src_key[at], pa.int64()),
            "src_start": pa.array(src_start[at].astype(np.int32)),
        }
    )


def _sources(entries: Entries, rank: np.ndarray) -> tuple[pa.Table, np.ndarray]:
    """Runs of the edges that a document with a smaller id has, and whether an entry belongs to its edge's first one."""
    order = np.lexsort((entries.places, rank, entries.hashes))
    hashes, doc, places = entries.hashes[order], entries.doc[order], entries.places[order]
    new = np.ones(len(order), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(order) else order
    later = entries.ids[doc] > entries.ids[doc[first]]
    found = _runs(entries.keys[doc[later]], places[later], entries.keys[doc[first[later]]], places[first[later]])
    own = np.zeros(len(order), bool)
    own[order] = ~later
    return found, own


def _send_edges(buckets: int, window: int, anchor: int, block_words: int):
    """Rows of packed edges (kind 0), and of runs already found within the block (kind 1, one row per bucket)."""

    def finish(block: _Block) -> Iterator[pa.RecordBatch]:
        ids, keys, (doc, start, hashes, bucket) = block.take()
        entries = Entries(ids, keys, doc, hashes, start)
        found, own = _sources(entries, doc)
        kept = entries.select(own)
        order = np.lexsort((kept.places, kept.doc))
        yield packed(kept.select(order), bucket[own][order])
        if len(found):
            yield _packed_runs(found, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches:
            ids, keys = np.asarray(batch.column(0), np.int64), np.asarray(batch.column(1), np.int64)
            lists = batch.column(3)
            offsets, shared = np.asarray(lists.offsets, np.int64), np.asarray(lists.values, np.int64)
            for part in words_of(batch.column(2), "space", lower=False):
                rows = slice(part.first_row, part.first_row + part.rows)
                starts, at, _ = _anchors(part, window, anchor)
                a, z = offsets[part.first_row], offsets[part.first_row + part.rows]
                row_of = np.repeat(np.arange(part.rows), np.diff(offsets[part.first_row : part.first_row + part.rows + 1]))
                marked = np.zeros(len(part.hashes), bool)
                marked[part.bounds[row_of] + shared[a:z]] = True
                keep = marked[at]
                starts, at = starts[keep], at[keep]
                row = part.row[starts]
                edges = part.rolled(window)[starts] if len(starts) else np.zeros(0, np.uint64)
                bucket = bucket_of(part.rolled(anchor)[at], buckets) if len(at) else at
                block.add(ids[rows], keys[rows], row, starts - part.bounds[row], edges, bucket)
                if block.size >= block_words // 2:
                    yield from finish(block)
        if block.size:
            yield from finish(block)

    return run


def _packed_runs(found: pa.Table, buckets: int) -> pa.RecordBatch:
    """Runs as rows of kind 1: keys, source keys, places and sizes in the columns that edges use for theirs."""
    key = np.asarray(found["key"])
    bucket = bucket_of(key.view(np.uint64), buckets)
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    names = ("src_key", "key", "size", "start", "src_start")
    columns = [np.asarray(found[c])[order] for c in names]
    rows = [[c[a:z].tobytes() for a, z in zip(edges, edges[1:], strict=False)] for c in columns]
    count = len(edges) - 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[order][edges[:-1]].astype(np.int32)),
            pa.array(np.ones(count, np.int32)),
            *(pa.array(r, pa.binary()) for r in rows),
        ],
        names=["bucket", "kind", "ids", "keys", "counts", "hashes", "places"],
    )


def _merged_edges(table: pa.Table) -> pa.Table:
    entries = unpacked(table.filter(pc.equal(table["kind"], 0)))
    found, _ = _sources(entries, _by_id(entries))
    tables = [found]
    for row in table.filter(pc.equal(table["kind"], 1)).to_pylist():
        tables.append(
            pa.table(
                {
                    "key": pa.array(np.frombuffer(row["keys"], np.int64)),
                    "start": pa.array(np.frombuffer(row["hashes"], np.int32)),
                    "size": pa.array(np.frombuffer(row["counts"], np.int32)),
                    "src_key": pa.array(np.frombuffer(row["ids"], np.int64)),
                    "src_start": pa.array(np.frombuffer(row["places"], np.int32)),
                }
            )
        )
    return pa.concat_tables(tables)


def paths(runs: DataFrame) -> DataFrame:
    """Whole paths: runs of one document and one diagonal of source coordinates that touch or overlap, put together."""
    line = Window.partitionBy("key", "src_key", "diagonal").orderBy("start", "size")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    return (
        runs.withColumn("diagonal", F.col("src_start") - F.col("start"))
        .withColumn("end", F.col("start") + F.col("size"))
        .withColumn("reach", F.max("end").over(before))
        .withColumn("path", F.count_if(F.col("reach").isNull() | (F.col("start") > F.col("reach"))).over(line))
        .groupBy("key", "src_key", "diagonal", "path")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .select(
            "key",
            "start",
            (F.col("end") - F.col("start")).alias("size"),
            "src_key",
            (F.col("start") + F.col("diagonal")).alias("src_start"),
        )
    )


def _digest(words: list[bytes], start: int, size: int) -> bytes:
    return hashlib.blake2b(b" ".join(words[start : start + size]), digest_size=16).digest()


def _source_digests(window: int):
    """Digest of the words of every span that is some path's source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for key, text, spans in zip(*batch.columns[1:], strict=True):
                words = text.as_py().encode().split()
                for span in spans.as_py():
                    values = (
                        key.as_py(),
                        span["src_start"],
                        span["size"],
                        _digest(words, span["src_start"], span["size"] + window - 1),
                    )
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["key", "src_start", "size", "digest"]
            )

    return run


def _remove(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            valid = lists.is_valid().to_pylist()
            offsets = lists.offsets.to_pylist()
            spans = lists.values
            start, size = (np.asarray(spans.field(i)) for i in (0, 1)) if len(spans) else (None, None)
            digests = spans.field(2)
            total, removed, kept, cut = [], [], [], []
            for i, text in enumerate(batch.column(1)):
                words = (text.as_py() or "").encode().split()
                keep = np.ones(len(words), bool)
                if valid[i]:
                    for j in range(offsets[i], offsets[i + 1]):
                        a, n = int(start[j]), int(size[j]) + window - 1
                        if _digest(words, a, n) == digests[j].as_py():
                            keep[a : a + n] = False
                total.append(len(words))
                removed.append(int(len(words) - keep.sum()))
                kept.append(b" ".join(compress(words, keep.tolist()) if removed[-1] else words))
                edge = np.flatnonzero(np.diff(keep, prepend=True, append=True)).reshape(-1, 2)
                cut.append([{"start": int(a), "end": int(z)} for a, z in edge])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array(total, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(cut, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                ],
                names=["doc_id", "n_words", "n_removed", "kept", "removed"],
            )

    return run


def dedup(
    spark: SparkSession,
    documents: DataFrame,
    window: int = WINDOW,
    anchor: int = ANCHOR,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Every row of ``documents`` without the words that a window repeated from a smaller doc_id covers.

    Words lie between \\x20 and \\x09-\\x0D and are taken unchanged from the whole text. A window of ``window`` words is
    repeated if its words also start somewhere in a row with a smaller doc_id; windows are judged on the input, not on
    what is left of it. Columns: doc_id, n_words, n_removed, kept (the other words, joined by one space) and removed
    (spans of word places, end exclusive).

    A null or empty text has no words, a text of fewer words no window. Rows with a null doc_id come back whole and
    nobody's source. Rows of one doc_id are never each other's source, so repeated rows keep what no smaller id has. An
    empty table gives no rows. Other columns are not read.

    Windows are found by 64-bit hashes and removed only after their source has been compared; a path whose source has
    other words, a collision, is left in place.
    """
    buckets = bucket_count(spark)
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("doc_id", "text").alias("key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    known = texts.where(F.col("doc_id").isNotNull())
    anchors = (
        known.mapInArrow(_send_anchors(buckets, window, anchor, block_words), PACKED_DDL)
        .groupBy("bucket")
        .applyInArrow(lambda _, table: _shared_anchors(table), "key long, place int")
        .groupBy("key")
        .agg(F.collect_set("place").alias("places"))
    )
    runs = (
        texts.join(anchors, "key")
        .select("doc_id", "key", "text", "places")
        .mapInArrow(_send_edges(buckets, window, anchor, block_words), PACKED_DDL)
        .groupBy("bucket")
        .applyInArrow(lambda _, table: _merged_edges(table), RUN_DDL)
    )
    whole = paths(runs)
    wanted = (
        whole.select("src_key", "src_start", "size")
        .distinct()
        .groupBy("src_key")
        .agg(F.collect_list(F.struct("src_start", "size")).alias("spans"))
        .withColumnRenamed("src_key", "key")
    )
    digests = (
        texts.join(wanted, "key")
        .dropDuplicates(["key"])  # repeated rows; the join has dealt rows by key already
        .select("doc_id", "key", "text", "spans")
        .mapInArrow(_source_digests(window), "key long, src_start int, size int, digest binary")
        .withColumnRenamed("key", "src_key")
    )
    spans = (
        whole.join(digests, ["src_key", "src_start", "size"])
        .groupBy("key")
        .agg(F.collect_list(F.struct("start", "size", "digest")).alias("spans"))
    )
    return (
        texts.join(spans, "key", "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(
            _remove(window),
            "doc_id long, n_words long, n_removed long, kept string, removed array<struct<start: int, end: int>>",
        )
    )
