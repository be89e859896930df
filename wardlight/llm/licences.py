"""Licence scan: canonical texts and paragraphs, looked up by digest among known licences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Notices and short licence texts as their owners publish them, one row per spelling.
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\");"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
]

# Spellings that a licence text may use for one another, in canonical spelling (lower case, no symbols).
SPELLINGS = [
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("analogue", "analog"),
    ("merchantibility", "merchantability"),
    ("wilful", "willful"),
    ("non commercial", "noncommercial"),
    ("sub license", "sublicense"),
    ("v 2 0", "version 2 0"),
    ("v 3", "version 3"),
    ("copyright owner", "copyright holder"),
]

# Whole licence texts, without their copyright lines.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
KNOWN += [("MIT", MIT), ("MIT", f"MIT License\n\n{MIT}"), ("ISC", ISC), ("ISC", f"ISC License\n\n{ISC}")]

# RE2 and Java read these patterns alike; they meet one lower-cased line at a time.
COPYRIGHT_LINE = r"^[^a-z0-9]*(copyright|\(c\)|©).*[0-9][0-9][0-9][0-9]"
SYMBOLS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_lines(text: Column) -> Column:
    """The lines that are no copyright lines, lower-cased, with two spaces between words and around them."""
    lines = F.filter(F.split(ascii_lower(text), "\n"), lambda line: ~line.rlike(COPYRIGHT_LINE))
    return F.transform(lines, lambda line: F.concat(F.lit(" "), F.regexp_replace(line, SYMBOLS, "  "), F.lit(" ")))


def respelled(plain: Column) -> Column:
    """One spelling of equivalent words, then one space between words."""
    for spelling, usual in SPELLINGS:
        plain = F.replace(plain, F.lit(f" {spelling.replace(' ', '  ')} "), F.lit(f" {usual.replace(' ', '  ')} "))
    return F.trim(F.regexp_replace(plain, " +", " "))


def canonical(text: Column) -> Column:
    """A whole text's canonical form; lines are joined before spellings are compared, as licences wrap anywhere."""
    return respelled(F.array_join(plain_lines(text), ""))


def known_licences(spark: SparkSession, known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """(digest, licence, size): the known texts by canonical digest; of one digest's names the first counts."""
    table = spark.createDataFrame([(i, *row) for i, row in enumerate(known)], "place int, licence string, text string")
    text = canonical(F.col("text"))
    return (
        table.select("place", "licence", F.sha2(text, 256).alias("digest"), F.length(text).alias("size"))
        .groupBy("digest")
        .agg(F.min_by("licence", "place").alias("licence"), F.max("size").alias("size"))
    )


def scan(documents: DataFrame, licences: DataFrame, broadcast_rows: int = 100_000) -> DataFrame:
    """One row per row of ``documents``: the canonical digest of its text and the licences it is or holds.

    text_licence is the licence whose canonical text equals the whole canonical text (null if none). licences are the
    names found among its lines by the same digests, sorted and comma-joined, n_notices counts those lines. state is
    ``whole``, ``notice`` or ``none``. A null text counts as empty and holds none. Null ids and repeated rows are kept,
    each row with its own result; an empty table gives no rows; other columns are not read.

    Digests move, texts do not: whole texts and lines are hashed where they are read and meet the known digests in a
    hash join, broadcast if ``licences`` has at most ``broadcast_rows`` rows. Lines that are longer than every known
    text are not hashed.
    """
    limits = licences.agg(F.count("*").alias("n"), F.max("size").alias("size")).first()
    table = licences.select(F.col("digest").alias("known"), "licence")
    if limits["n"] <= broadcast_rows:
        table = F.broadcast(table)
    rows = documents.select(
        F.col("doc_id").alias("doc_id"),
        F.xxhash64("doc_id", "text").alias("row_key"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("row_digest"),
        plain_lines(F.coalesce("text", F.lit(""))).alias("lines"),
    ).select(
        "doc_id",
        "row_key",
        "row_digest",
        F.sha2(respelled(F.array_join("lines", "")), 256).alias("canonical_sha256"),
        F.filter(
            F.transform("lines", respelled), lambda line: (line != "") & (F.length(line) <= (limits["size"] or 0))
        ).alias("lines"),
    )
    notices = (
        rows.select("doc_id", "row_key", "row_digest", F.posexplode("lines").alias("place", "line"))
        .select("doc_id", "row_key", "row_digest", "place", F.sha2("line", 256).alias("digest"))
        .join(table, F.col("digest") == F.col("known"))
        .select("doc_id", "row_key", "row_digest", "place", "licence")
        .distinct()  # equal rows find the same lines
        .groupBy("doc_id", "row_key", "row_digest")
        .agg(F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("licences"), F.count("*").alias("n_notices"))
        .withColumnsRenamed({"doc_id": "n_doc", "row_key": "n_key", "row_digest": "n_digest"})
    )
    whole = table.select(F.col("known").alias("w_known"), F.col("licence").alias("text_licence"))
    return (
        rows.drop("lines")
        .join(F.broadcast(whole) if limits["n"] <= broadcast_rows else whole, F.col("canonical_sha256") == F.col("w_known"), "left")
        .join(
            notices,
            (F.col("row_key") == F.col("n_key"))
            & (F.col("row_digest") == F.col("n_digest"))
            & F.col("doc_id").eqNullSafe(F.col("n_doc")),
            "left",
        )
        .select(
            "doc_id",
            "canonical_sha256",
            "text_licence",
            F.coalesce("licences", F.lit("")).alias("licences"),
            F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"),
            F.when(F.col("text_licence").isNotNull(), "whole")
            .when(F.col("n_notices") > 0, "notice")
            .otherwise("none")
            .alias("state"),
        )
    )
