"""Best-fit packing: partitions pack locally, then underfull bins are merged as items up a tree of partitions."""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.llm.tables import written

CAPACITY = 2048
#: a bin with at most this many free places counts as full and leaves the tree
SLACK = 4
#: underfull bins that one merge task takes on; also the least fan-in of 2 keeps within it, see ``pack``
GROUP_ROWS = 50_000

# Fixed value: the public byte-level BPE's split of a text into pieces, the same as public_tokenizers.PATTERN.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Letters, digits and symbols whose Unicode classes are the same in every library version.
PLAIN = r"[\x00-\x7F\u00A1-\u024F\u2010-\u2015\u2018-\u201F\u2026\u20AC]*"


class Encoder:
    """Ids of whole texts by a public byte-level BPE, as tokenizers gives them without adding special tokens.

    ``path`` is the vocabulary for tokenizers, which defines the ids. ``ranks`` is the same vocabulary as ranks, with
    which tiktoken gives the same ids several times faster; without it, for texts with characters that the two libraries
    might class differently, or for texts that hold the string of a special token, tokenizers does the work.
    """

    def __init__(self, path: str, ranks: str | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain = re.compile(PLAIN).fullmatch
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=PIECES, mergeable_ranks=merges, special_tokens={})

    def __call__(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit values."""
        if self.fast and (text.isascii() or self.plain(text)) and not any(token in text for token in self.special):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every item, and the fill of every bin: items by falling size, each into the fullest bin it fits."""
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    fills: list[int] = []
    by_room: dict[int, list[int]] = {}
    rooms: list[int] = []  # the distinct sizes of the open bins' free places, sorted
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[at]
        else:
            b, room = len(fills), capacity
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += size
        if left := room - size:
            if left in by_room:
                by_room[left].append(b)
            else:
                by_room[left] = [b]
                insort(rooms, left)
    return bins, offsets, np.array(fills, np.int64)


@cache
def encoder(path: str, ranks: str | None) -> Encoder:
    """One encoder for all tasks of a worker process; loading the vocabulary takes as long as a small task."""
    return Encoder(path, ranks)


PIECE_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED_DDL = f"{PIECE_DDL}, bin_id long, offset long, fill long"


def _pieces(path: str, ranks: str | None, capacity: int):
    """The pieces of every document of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, ranks)
        for batch in batches:
            doc, piece, start, length, crc = [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + b"\0\0\0\0"
                total = len(ids) // 4
                first = total % capacity or capacity
                edges = [0, *range(min(first, total), total + 1, capacity)]
                for k, (a, z) in enumerate(zip(edges, edges[1:], strict=False)):
                    doc.append(doc_id)
                    piece.append(k)
                    start.append(a)
                    length.append(z - a)
                    crc.append(zlib.crc32(ids[4 * a : 4 * z]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, pa.int64()),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def _packed(capacity: int):
    """The local bins of the pieces dealt to one task; a bin's number begins with that of the deal."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        bins, offsets, fills = best_fit(np.asarray(table["length"], np.int64), capacity)
        out = table.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        for name, values in (("bin_id", bins + (key[0].as_py() << 33)), ("offset", offsets), ("fill", fills[bins])):
            out = out.append_column(name, pa.array(values))
        return out

    return run


def _merge(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(table["bin_id"]), kind="stable")
        ids = np.asarray(table["bin_id"], np.int64)[order]
        fills = np.asarray(table["fill"], np.int64)[order]
        bins, offsets, totals = best_fit(fills, capacity)
        # a merged bin is named after its first member, so names stay unique without a counter
        name = np.empty(len(totals), np.int64)
        name[bins[offsets == 0]] = ids[offsets == 0]
        return pa.table({"bin_id": ids, "parent": name[bins], "at": offsets, "fill": totals[bins], "had": fills})

    return run


def pack(
    spark: SparkSession,
    documents: DataFrame,
    tokenizer_path: str,
    ranks_path: str | None = None,
    capacity: int = CAPACITY,
    slack: int = SLACK,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """All documents in sequences of at most ``capacity`` tokens: one row per piece, with its sequence and offset.

    Vocabulary paths must exist on every executor, see ``Encoder``. A document is the ids of its text and id 0; a null or
    empty text is id 0 alone. Only a longer document is cut, into pieces of ``capacity``; its first piece takes what is
    left over. The pieces are dealt to partitions of about ``group_rows`` by a hash of their number, so that each has
    long and short ones however the table is laid out, and every partition packs its pieces best fit, the largest first.
    Bins with at most ``slack`` free places are done. The others are items of the next round, where one task merges the
    bins of several partitions best fit again, and so on up the tree.

    A bin that a round of merging leaves as it was is done too, so every round at least halves the items. The fan-in
    follows the number of items, two partitions at least, so the halving keeps every task near ``group_rows`` items
    however many partitions there are. No bin is dropped: one that leaves the tree is a sequence.

    Repeated rows are packed as often as they occur; null ids are kept; an empty table gives no rows. Only doc_id and
    text are read.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    cut = rows.mapInArrow(_pieces(tokenizer_path, ranks_path, capacity), PIECE_DDL)
    cut = written(spark, cut.withColumn("number", F.monotonically_increasing_id()), "cut-pieces")
    deals = max(1, -(-cut.count() // group_rows))
    dealt = cut.withColumn("deal", F.pmod(F.xxhash64("number"), F.lit(deals)))
    # later rounds refer to bins by name, so the local bins are written once and never computed again
    pieces = written(spark, dealt.groupBy("deal").applyInArrow(_packed(capacity), PLACED_DDL), "pieces")
    open_bins = pieces.where((F.col("offset") == 0) & (F.col("fill") < capacity - slack)).select(
        "bin_id", "fill", F.shiftright("bin_id", 33).alias("leaf")
    )
    rounds: list[DataFrame] = []
    width = 1
    while True:
        size = open_bins.agg(F.count("*").alias("n"), F.max("leaf").alias("last")).first()
        if not size["n"]:
            break
        leaves = size["last"] // width + 1
        fan_in = max(2, int(group_rows * leaves // size["n"]))
        width *= fan_in
        merged = (
            open_bins.withColumn("part", F.floor(F.col("leaf") / width))
            .groupBy("part")
            .applyInArrow(
                lambda _, table: _merge(capacity)(table), "bin_id long, parent long, at long, fill long, had long"
            )
        )
        rounds.append(written(spark, merged, f"merge-{len(rounds)}"))
        if width > size["last"]:
            break
        open_bins = (
            rounds[-1]
            .where((F.col("at") == 0) & (F.col("fill") > F.col("had")) & (F.col("fill") < capacity - slack))
            .select("bin_id", "fill", F.shiftright("bin_id", 33).alias("leaf"))
        )
    placed = None  # where each merged bin of a round ends up
    for level in reversed(rounds):
        step = level.select(F.col("bin_id").alias("from_bin"), "parent", "at")
        if placed is not None:
            above = placed.select(F.col("from_bin").alias("parent"), F.col("parent").alias("root"), F.col("at").alias("more"))
            step = step.join(above, "parent", "left").select(
                "from_bin",
                F.coalesce("root", "parent").alias("parent"),
                (F.col("at") + F.coalesce("more", F.lit(0))).alias("at"),
            )
        placed = step
    if placed is None:
        out = pieces.withColumn("sequence_id", F.col("bin_id"))
    else:
        out = (
            pieces.join(placed, F.col("bin_id") == F.col("from_bin"), "left")
            .withColumn("sequence_id", F.coalesce("parent", "bin_id"))
            .withColumn("offset", F.col("offset") + F.coalesce("at", F.lit(0)))
        )
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
