"""Line dedup: winnowing over line hashes, positions joined by fingerprint, matches extended both ways, later runs deleted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.llm.tables import spare, written

#: words from which on a run of lines is deleted where it is repeated; also the most lines of a window
RUN_WORDS = 8
#: so many characters of a line count as a word where it has fewer words
WORD_CHARS = 10
#: fixed: a word
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _lines(text: Column, run_words: int) -> Column:
    """(at, hash, words) of the lines that have words; ``at`` is the place among all lines.

    Words count up to ``run_words``, so those of a line that is long enough need not be told apart.
    """
    most = F.lit(run_words)

    def entry(line: Column, at: Column) -> Column:
        tenth = F.floor(F.length(line) / WORD_CHARS).cast("int")
        count = F.regexp_count(line, F.lit(WORD)).cast("int")
        words = (
            F.when(F.length(line) >= WORD_CHARS * run_words, F.when(line.rlike(WORD), most).otherwise(0))
            .when(count == 0, 0)
            .otherwise(F.least(F.greatest(count, tenth), most))
        )
        return F.struct(
            at.cast("int").alias("at"), F.md5(line.cast("binary")).alias("hash"), words.alias("words")
        )

    return F.filter(F.transform(F.split(text, "\n"), entry), lambda line: line["words"] > 0)


def _line(lines: Column, i: Column) -> Column:
    """The window of one line that has the words alone."""
    own = F.get(lines, i)
    return F.struct(
        F.unhex(own["hash"]).alias("print"),
        own["at"].alias("at"),
        F.unhex(own["hash"]).alias("run"),
        own["at"].alias("start"),
        own["at"].alias("end"),
        F.coalesce(F.get(lines, i - 1)["at"], F.lit(-1)).alias("before"),
        F.coalesce(F.get(lines, i + 1)["at"], F.lit(-1)).alias("after"),
    )


def _window(lines: Column, first: Column, count: Column) -> Column:
    """What is kept of a window: its fingerprint, the minimum of its lines, and its own hash and extent.

    The line of the most words is the least, then that of the least hash: content alone decides, so equal windows have
    equal fingerprints, and short lines that are everywhere are fingerprints of no more windows than they must.
    ``before`` and ``after`` are the places of the lines with words around it, -1 if there is none.
    """
    own = F.slice(lines, first + 1, count)
    least = F.array_min(
        F.transform(own, lambda x: F.struct((-x["words"]).alias("w"), x["hash"].alias("h"), x["at"].alias("at")))
    )
    whole = F.md5(F.array_join(F.transform(own, lambda x: x["hash"]), "").cast("binary"))
    return F.struct(
        F.unhex(least["h"]).alias("print"),
        least["at"].alias("at"),
        F.unhex(whole).alias("run"),
        F.get(lines, first)["at"].alias("start"),
        F.get(lines, first + count - 1)["at"].alias("end"),
        F.coalesce(F.get(lines, first - 1)["at"], F.lit(-1)).alias("before"),
        F.coalesce(F.get(lines, first + count)["at"], F.lit(-1)).alias("after"),
    )


def windows(text: Column, run_words: int) -> Column:
    """The shortest runs of at least ``run_words`` words from every line on and up to every line, once each.

    Every line with words has one, so a window has at most ``run_words`` lines. Any run of that many words holds the
    window of each of its lines, either from that line on or up to the run's end.
    """

    def reach(part: Column) -> Column:
        """Number of lines of ``part`` that make up the words, 0 if all of them do not."""
        start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("n"))

        def add(acc: Column, line: Column) -> Column:
            return F.when(acc["words"] >= run_words, acc).otherwise(
                F.struct((acc["words"] + line["words"]).alias("words"), (acc["n"] + 1).alias("n"))
            )

        return F.aggregate(part, start, add, lambda acc: F.when(acc["words"] >= run_words, acc["n"]).otherwise(0))

    def around(lines: Column, i: Column) -> Column:
        """The windows from line ``i`` on and up to it; one if the line has the words alone."""
        least = F.greatest(i - (run_words - 1), F.lit(0))
        onwards = F.slice(lines, i + 1, run_words)
        upto = F.reverse(F.slice(lines, least + 1, i - least + 1))
        forwards = F.transform(F.array(reach(onwards)), lambda n: F.when(n > 0, _window(lines, i, n)))
        backwards = F.transform(F.array(reach(upto)), lambda n: F.when(n > 0, _window(lines, i - n + 1, n)))
        alone = F.get(lines, i)["words"] >= run_words
        return F.when(alone, F.array(_line(lines, i))).otherwise(F.concat(forwards, backwards))

    # the lines are hashed once, as the argument of the outer transform
    found = F.transform(
        F.array(_lines(text, run_words)),
        lambda lines: F.when(
            F.size(lines) > 0,
            F.flatten(F.transform(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: around(lines, i))),
        ),
    )
    return F.array_distinct(F.filter(F.get(found, F.lit(0)), lambda w: w.isNotNull()))


def repeated_runs(spark: SparkSession, documents: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """(row_key, doc_id, deleted): the places of the lines of a row that are repeated from earlier ones."""
    prints = written(
        spark,
        documents.select(
            F.col("doc_id").alias("doc_id"),
            F.xxhash64("doc_id", "text").alias("row_key"),
            F.explode(windows(F.coalesce("text", F.lit("")), run_words)).alias("w"),
        ).select("doc_id", "row_key", "w.*"),
        "prints",
    )
    # positions joined: fingerprints of one place only have nothing to match. Repeated rows are one document.
    place = F.struct("doc_id", "row_key", "at")
    repeated = (
        prints.groupBy("print")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first != last")
        .select("print")
    )
    # written, so that the joins can split a fingerprint that a third of all rows hold
    matched = written(
        spark, prints.join(written(spark, repeated, "repeated-prints"), "print", "left_semi").drop("print", "at"), "matched"
    )
    # a match is extended to the lines around it that make up a run: equal runs have equal hashes
    run = F.struct("doc_id", "row_key", "start")
    first = written(
        spark,
        matched.groupBy("run").agg(F.min(run).alias("first"), F.max(run).alias("last")).where("first != last")
        .select("run", "first"),
        "first-runs",
    )
    # lines without words go between two lines that go: where one run ends and the next begins, pairs packed as numbers
    pair = 1 << 32
    ends = F.transform("runs", lambda r: r["end"] * F.lit(pair) + r["after"])
    starts = F.transform("runs", lambda r: r["before"] * F.lit(pair) + r["start"])
    between = F.transform(
        F.array_intersect(ends, starts),
        lambda p: F.sequence(F.floor(p / pair).cast("int"), (p % pair).cast("int")),
    )
    inside = F.transform("runs", lambda r: F.sequence(r["start"], r["end"]))
    places = F.array_distinct(F.flatten(F.concat(inside, between)))
    return (
        matched.join(first, "run")
        .where(~run.eqNullSafe(F.col("first")))
        .groupBy("doc_id", "row_key")
        .agg(F.collect_set(F.struct("start", "end", "before", "after")).alias("runs"))
        .select("doc_id", "row_key", places.alias("deleted"))
    )


def dedup(spark: SparkSession, documents: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """Every row of ``documents`` without the runs of lines that are repeated from earlier lines.

    Lines are what stands between line feeds. A line has as many words as it has runs of ASCII digits and letters and of
    characters beyond ASCII, or a tenth of its characters if that is more; one without any such run has none. Lines
    without words are passed over when lines are compared. A run of successive lines that has at least ``run_words``
    words and occurs before, in the order of (doc_id, text hash, place), in whichever document, is deleted; lines without
    words go where the lines with words before and after them both go. So a long line goes that is repeated alone, and short lines go together; blank lines,
    braces and short lines that are repeated alone stay. Everything is judged on the input, so the first occurrence of a
    run stays, and exactly the lines go that lie in some repeated run.

    All columns of ``documents`` stay, whatever their names; text is replaced by the lines that are left (joined by
    line feeds), and n_lines, n_removed (long) are added, replacing columns of these names. A null text stays null and
    has no lines; a text that loses all lines is empty. Null ids come first in the order. Repeated rows are one document
    and get equal results. An empty table gives no rows.
    """
    own, doc, key, gone = spare(documents, "own_key", "run_doc", "run_key", "deleted")
    deleted = repeated_runs(spark, documents, run_words).toDF(doc, key, gone)
    keyed = documents.withColumn(own, F.xxhash64("doc_id", "text"))
    joined = keyed.join(deleted, (F.col(own) == F.col(key)) & F.col("doc_id").eqNullSafe(F.col(doc)), "left")
    lines = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    left = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long")
    return joined.withColumns(
        {
            "text": F.when(F.col(gone).isNull(), F.col("text")).otherwise(left),
            "n_lines": n_lines,
            "n_removed": F.coalesce(F.size(gone), F.lit(0)).cast("long"),
        }
    ).drop(own, doc, key, gone)
