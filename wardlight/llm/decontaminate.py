"""Benchmark decontamination: a prefix-filtered join of item windows with whole documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlight.llm.tables import written

WINDOW = 10
SHINGLE = 4
#: shingles of the benchmark that are broadcast at once; a larger benchmark is met in several passes
BROADCAST_ROWS = 500_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words between ASCII symbols with A-Z lower-cased; a null text has none."""
    text = F.coalesce(text, F.lit(""))
    # lower() changes letters beyond ASCII too, translate() is slow
    plain = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    parts = F.split(plain, SYMBOLS)
    # only the first and the last part can be empty
    first = F.when(F.get(parts, F.lit(0)) == "", 2).otherwise(1)
    last = F.when((F.size(parts) > 1) & (F.get(parts, F.size(parts) - 1) == ""), 1).otherwise(0)
    return F.slice(parts, first, F.greatest(F.size(parts) - first + 1 - last, F.lit(0)))


def _hash(tokens: str, at: Column, size: int) -> Column:
    return F.xxhash64(*(F.get(F.col(tokens), at + j) for j in range(size)))


def item_windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(window, items, size): the distinct windows, the items that hold each, and the size of its shingles.

    A window is ``window`` consecutive words; an item of fewer words, but not none, is one window. Shingles of a short
    window are at most as long as the window.
    """
    items = benchmark.select(F.col("item_id").alias("item_id"), words(F.col("text")).alias("tokens")).where(
        F.size("tokens") > 0
    )
    size = F.least(F.size("tokens"), F.lit(window))
    starts = F.transform(
        F.sequence(F.lit(0), F.size("tokens") - size), lambda i: F.slice(F.col("tokens"), i + 1, size)
    )
    return (
        items.select("item_id", F.explode(starts).alias("window"))
        .groupBy("window")
        .agg(F.collect_set("item_id").alias("items"))
        .withColumn("size", F.least(F.size("window"), F.lit(shingle)))
    )


def shared_places(
    documents: DataFrame, places: DataFrame, sizes: dict[int, int], window: int, limit: int
) -> DataFrame:
    """Places of documents whose shingle some window has, with the words that a window there could cover.

    Every row of ``documents`` also gives one row with the place -1. The shingles of the windows are broadcast,
    ``limit`` at a time, so nothing of a document moves but the places found. ``sizes``: distinct shingles by size.
    """
    tokens = documents.select(
        F.col("doc_id").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row_key"), words(F.col("text")).alias("tokens")
    )
    out = None
    for size, count in (sizes or {0: 0}).items():
        own = places.where(F.col("size") == size).select(F.col("hash").alias("wanted")).distinct()
        passes = max(1, -(-count // limit))
        for turn in range(passes):
            first = -1 if out is None else 0
            wanted = own.where(F.pmod("wanted", F.lit(passes)) == turn)
            marker = F.lit(0).cast("long")
            if first < 0:
                wanted = wanted.unionByName(wanted.sparkSession.range(1).select(marker.alias("wanted")))
            last = F.size("tokens") - size if size else F.lit(-1)
            here = _hash("tokens", F.col("at"), size) if size else marker
            found = (
                tokens.where(F.lit(True) if first < 0 else F.size("tokens") >= size)
                .select("*", F.explode(F.sequence(F.lit(first), F.greatest(last, F.lit(first)))).alias("at"))
                .withColumn("hash", F.when(F.col("at") < 0, marker).otherwise(here))
                .join(F.broadcast(wanted), F.col("hash") == F.col("wanted"), "left_semi")
            )
            begin = F.greatest(F.col("at") - (window - size), F.lit(0))
            found = found.select(
                "doc_id",
                "row_key",
                F.size("tokens").alias("n_words"),
                "at",
                "hash",
                F.lit(size).alias("size"),
                begin.alias("begin"),
                F.slice("tokens", begin + 1, F.when(F.col("at") < 0, 0).otherwise(F.col("at") + window - begin)).alias(
                    "context"
                ),
            )
            out = found if out is None else out.unionByName(found)
    return out


def contamination(
    spark: SparkSession,
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Per row of ``documents``: its words, those inside an occurrence of an item's window, and the items.

    1. Places of documents whose shingle of ``shingle`` words some item window has. Counting them gives every shingle's
       frequency in the whole corpus.
    2. A window can occur only where its rarest shingle does: that one shingle is the prefix to join, as the threshold
       is containment of the whole window. Its offset fixes where the window would start; a start before the document
       or with too few words after it falls to the position and length bounds.
    3. What is left is verified word by word over the item-sized window.

    Columns: doc_id, row_key, n_words, n_hit (long), hits (sorted places of hit words), items (item ids as text,
    sorted). Null and empty texts have no words; an item without words has no window; a null item_id names no item but
    its windows still hit. Equal windows of several items count for all of them. Repeated rows get equal results each;
    an empty benchmark hits nothing; an empty table gives no rows. Other columns are not read.
    """
    windows = written(spark, item_windows(benchmark, window, shingle), "windows")
    offset = F.explode(F.sequence(F.lit(0), F.size("window") - F.col("size"))).alias("offset")
    places = windows.select("window", "items", "size", offset)
    key = F.lit(0).cast("long")
    for size in range(1, shingle + 1):
        key = F.when(F.col("size") == size, _hash("window", F.col("offset"), size)).otherwise(key)
    places = written(spark, places.withColumn("hash", key), "window-shingles")
    # at most ``shingle`` rows
    counts = places.groupBy("size").agg(F.count_distinct("hash").alias("n")).collect()
    sizes = {row["size"]: row["n"] for row in sorted(counts, key=lambda row: row["size"])}
    seen = written(spark, shared_places(documents, places, sizes, window, broadcast_rows), "shared-places")
    rows = seen.where("at < 0").select("doc_id", "row_key", F.col("n_words").cast("long").alias("n_words"))
    seen = seen.where("at >= 0")
    rarity = seen.groupBy("size", "hash").agg(F.count("*").alias("n"))
    ranked = Window.partitionBy("window").orderBy("n", "hash", "offset")
    whole = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    prefix = written(
        spark,
        places.join(rarity, ["size", "hash"])
        .withColumn("rank", F.row_number().over(ranked))
        .withColumn("have", F.count("*").over(whole))
        # a window with a shingle that no document has occurs nowhere
        .where((F.col("rank") == 1) & (F.col("have") == F.size("window") - F.col("size") + 1))
        .select("window", "items", "size", "offset", "hash"),
        "prefixes",
    )
    start = F.col("at") - F.col("offset")
    length = F.size("window")
    starts = (
        seen.join(_sized(prefix, broadcast_rows), ["size", "hash"])
        .where((start >= 0) & (start + length <= F.col("n_words")))
        .where(F.slice("context", start - F.col("begin") + 1, length) == F.col("window"))
        .select("row_key", "doc_id", start.alias("start"), length.alias("length"), "items")
    )
    found = (
        starts.groupBy("row_key", "doc_id")
        .agg(
            F.collect_set(F.struct("start", "length")).alias("starts"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        )
        .select(
            F.col("row_key").alias("f_key"),
            F.col("doc_id").alias("f_doc"),
            F.array_sort(
                F.array_distinct(
                    F.flatten(
                        F.transform("starts", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1))
                    )
                )
            ).alias("hits"),
            F.array_sort(F.transform("items", lambda i: i.cast("string"))).alias("items"),
        )
    )
    same = (F.col("row_key") == F.col("f_key")) & F.col("doc_id").eqNullSafe(F.col("f_doc"))
    return rows.join(found, same, "left").select(
        "doc_id",
        "row_key",
        "n_words",
        F.coalesce(F.size("hits"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("hits", F.expr("cast(array() as array<int>)")).alias("hits"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
    )


def _sized(frame: DataFrame, limit: int) -> DataFrame:
    """Broadcast a written table only if its rows are few; else the join shuffles, and AQE splits hot keys."""
    return F.broadcast(frame) if frame.count() <= limit else frame
