"""Secret scan: candidate credentials, separated by how many repositories and owners hold them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.llm.tables import written

# The patterns of the base kinds, in the order in which ties of a start are listed. Letters of the names
# in either case are written out, as (?i) would take in letters beyond ASCII in some engines.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{14,}"  # the first 18 and more of a run, so a shorter match fails with or without the count
HEX = r"[0-9a-f]{16,}"
BARE = r"[A-Za-z0-9][A-Za-z0-9+/_.=-]{10,}[A-Za-z0-9]"
KINDS = ("assign", "access", "hex", "bare")
BASE_KINDS = 3
ASSIGN_VALUE = 12

#: distinct owners from which a value counts as a widely copied example
WIDE_OWNERS = 3

SPANS = "array<struct<start: int, value: string>>"


def matches(text: Column, pattern: str) -> Column:
    """(start, value) of the leftmost non-overlapping matches, in code points.

    The matches and the text between them are two arrays; their lengths add up to the positions.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.expr(f"cast(array() as {SPANS})")
    pairs = F.zip_with(
        found, F.slice(F.split(text, pattern, -1), 1, F.size(found)), lambda m, gap: F.struct(m.alias("m"), gap.alias("gap"))
    )
    listed = F.aggregate(
        pairs,
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["gap"]) + F.length(x["m"])).alias("at"),
            F.concat(
                acc["out"],
                F.array(F.struct((acc["at"] + F.length(x["gap"])).alias("start"), x["m"].alias("value"))),
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return F.when(text.rlike(pattern), listed).otherwise(none)


def spans_of(documents: DataFrame, id_col: str, repository_col: str, owner_col: str) -> DataFrame:
    """One row per row of ``documents``: the spans of the base kinds and the bare runs that touch none of them.

    ``bare`` are whole runs of 12 and more credential characters with a digit. A span's hash is that of its value
    without symbols at its end, such as the full stop of a sentence.
    """

    def spans(kind: int, pattern: str, value) -> Column:
        return F.transform(
            matches(F.col("body"), pattern),
            lambda m: F.struct(
                F.lit(kind).alias("kind"),
                m["start"].alias("start"),
                (m["start"] + F.length(m["value"])).alias("end"),
                value(m["value"]).alias("value"),
            ),
        )

    def hashed(column: str) -> Column:
        return F.transform(
            column,
            lambda s: F.struct(
                s["start"].alias("start"),
                s["kind"].alias("kind"),
                s["end"].alias("end"),
                F.sha2(F.regexp_replace(s["value"], "[^A-Za-z0-9]+$", ""), 256).alias("hash"),
            ),
        )

    rows = documents.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(F.col(id_col), "text").alias("row_key"),
        F.col(repository_col).cast("string").alias("repository"),
        F.col(owner_col).cast("string").alias("owner"),
        F.coalesce(F.col("text"), F.lit("")).alias("body"),
    )
    keys = ["doc_id", "row_key", "repository", "owner"]
    base = F.concat(
        F.filter(
            spans(0, ASSIGN, lambda v: F.regexp_extract(v, ASSIGN, 2)), lambda s: F.length(s["value"]) >= ASSIGN_VALUE
        ),
        spans(1, ACCESS, lambda v: v),
        spans(2, HEX, lambda v: v),
    )
    bare = F.filter(spans(3, BARE, lambda v: v), lambda s: s["value"].rlike("[0-9]"))
    return (
        rows.select(*keys, base.alias("base"), bare.alias("bare"))
        .select(
            *keys,
            F.array_sort(hashed("base")).alias("base"),
            F.filter(
                "bare", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
            ).alias("bare"),
        )
        .select(*keys, "base", hashed("bare").alias("bare"))
    )


def ownership(found: DataFrame, wide_owners: int = WIDE_OWNERS) -> DataFrame:
    """For every value that is a candidate of a base kind somewhere: its repositories, owners and verdict.

    Counts are distinct and exact. Rows of one value are reduced to its (repository, owner) pairs and then to its owners
    before they meet, so a value that a third of all rows hold is counted in as many tasks as it has pairs.
    """
    pairs = found.groupBy("hash", "owner", "repository").agg(
        F.max(F.col("kind") < BASE_KINDS).alias("named"), F.count("*").alias("n")
    )
    owners = pairs.groupBy("hash", "owner").agg(
        F.max("named").alias("named"), F.sum("n").alias("n"), F.count("repository").alias("repositories")
    )
    return (
        owners.groupBy("hash")
        .agg(
            F.max("named").alias("named"),
            F.sum("n").alias("occurrences"),
            F.sum("repositories").alias("repositories"),
            F.count("owner").alias("owners"),
        )
        .where("named")
        .select(
            "hash",
            "occurrences",
            "repositories",
            "owners",
            F.when(F.col("owners") >= wide_owners, "example").otherwise("live").alias("verdict"),
        )
    )


def _count(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def _listed(spans: Column) -> Column:
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ","
    )


def scan(
    spark: SparkSession,
    documents: DataFrame,
    id_col: str = "doc_id",
    repository_col: str = "doc_id",
    owner_col: str = "source",
    wide_owners: int = WIDE_OWNERS,
) -> tuple[DataFrame, DataFrame]:
    """Findings per row of ``documents`` and verdicts per value.

    Findings: doc_id, n_assign, n_access, n_hex, n_bare, n_live and n_example (long), base and spans (``kind:start:end``
    in code points, end exclusive, by start and then kind, comma-joined). Spans are the candidates of the base kinds and
    those bare runs whose value the corpus knows from a base kind elsewhere: a credential copied without its name. A
    value held by ``wide_owners`` distinct owners or more is a widely copied ``example``; any other looks ``live``.

    A null or empty text has no spans. A null owner or repository belongs to nobody and is not counted. Equal repeated
    rows are one repository and get the same findings each; an empty table gives no rows. Columns other than the
    given ones do not matter.
    """
    rows = written(spark, spans_of(documents, id_col, repository_col, owner_col), "secrets")
    found = rows.select(
        "doc_id", "row_key", "repository", "owner", F.explode(F.concat("base", "bare")).alias("s")
    ).select("doc_id", "row_key", "repository", "owner", "s.*")
    # written, so that the join below reads both sides anew and can split a value that a third of all rows hold
    values = written(spark, ownership(found, wide_owners), "secret-values")
    known = (
        found.select("doc_id", "row_key", "start", "kind", "end", "hash")
        .distinct()
        .join(values.select("hash", "verdict"), "hash")
        .groupBy("doc_id", "row_key")
        .agg(
            F.count_if(F.col("verdict") == "live").alias("n_live"),
            F.count_if(F.col("verdict") == "example").alias("n_example"),
            F.collect_list(
                F.when(F.col("kind") >= BASE_KINDS, F.struct("start", "kind", "end", "hash"))
            ).alias("added"),
        )
        .withColumnsRenamed({"doc_id": "k_doc", "row_key": "k_row"})
    )
    joined = rows.join(
        known, (F.col("row_key") == F.col("k_row")) & F.col("doc_id").eqNullSafe(F.col("k_doc")), "left"
    )
    none = F.lit(0).cast("long")
    findings = joined.select(
        "doc_id",
        *(_count(k).alias(f"n_{KINDS[k]}") for k in range(BASE_KINDS)),
        F.coalesce(F.size("added").cast("long"), none).alias("n_bare"),
        F.coalesce("n_live", none).alias("n_live"),
        F.coalesce("n_example", none).alias("n_example"),
        _listed(F.col("base")).alias("base"),
        _listed(
            F.array_sort(F.concat("base", F.coalesce("added", F.slice("base", 1, 0))))
        ).alias("spans"),
    )
    return findings, values
