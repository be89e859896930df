"""Tables that the operators share: intermediate results in the shared folder, bounded labelled samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.session import work_dir


def written(spark: SparkSession, frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as a Parquet table in the folder that all executors share; a lost executor loses none of it."""
    path = work_dir(spark, purpose)
    frame.write.parquet(path)
    return spark.read.parquet(path)


def spare(frame: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores put before it until no column of ``frame`` is called that."""
    taken = {name.lower() for name in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def labelled_sample(labels: DataFrame, label: str, held_out: Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_class`` ids of each class in the order of a hash of the id, and the class sizes in all of labels.

    Rows that are held out, have a null id or a label other than 0 and 1 are left out. Repeated labels of one id count
    once, with the larger label. The sample is bounded by ``2 * per_class`` rows whatever the size of ``labels``.
    """
    known = (
        labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    sizes = {row["label"]: row["n"] for row in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = [
        known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for value in (0, 1)
    ]
    return parts[0].unionByName(parts[1]), sizes
