"""Result tables as partitioned catalog tables: full and incremental refresh, appends, retention, JDBC.

All tables of one deployment live in one database of Spark's catalog and are found by name. They are partitioned by
``event_date``, the date of their time column; partial results and what streams add also by ``batch``. A refresh is an
``INSERT OVERWRITE``: of the whole table, or of just the partitions that the new rows have. Retention drops partitions.
Commits, snapshots and readers during a refresh are the catalog's and table format's affair.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from wardlight import schemas, settings
from wardlight.functions.text import as_of_time

PARTITION = "event_date"
BATCH = "batch"
#: fixed: the name that catalogs give to the partition of rows without a value
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: partitions that one statement drops
DROPPED_AT_ONCE = 500
#: partition columns of the tables that have others than the date alone
PARTITIONS = {
    "event_rollup": [PARTITION, BATCH],
    "late_events": [PARTITION, BATCH],
    "stream_progress": [PARTITION, BATCH],
    "data_quality_checks": [PARTITION, BATCH],
    "alert_log": [PARTITION, BATCH],
    "stored_events": [PARTITION, "event_type"],
}


def partitions(table: str) -> list[str]:
    return PARTITIONS.get(table, [PARTITION])


def create_database(spark: SparkSession, database: str, location: str | None = None) -> str:
    """The database, made if it is missing: in ``location``, by default in the warehouse of the catalog."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")
    return database


def exists(spark: SparkSession, database: str, table: str) -> bool:
    return spark.catalog.tableExists(f"`{database}`.`{table}`")


def existing(spark: SparkSession, database: str, *tables: str) -> list[str]:
    """Those of ``tables`` that the catalog has; the catalog is asked once."""
    found = {entry.name for entry in spark.catalog.listTables(f"`{database}`")}
    return [table for table in tables if table in found]


def _declared(field: StructField) -> str:
    return f"`{field.name}` {field.dataType.simpleString()}{'' if field.nullable else ' NOT NULL'}"


def create_table(spark: SparkSession, database: str, table: str) -> str:
    """The qualified name of a table, which is made from its declared schema if it is missing."""
    own = [f for f in schemas.RESULT_SCHEMAS[table].fields if f.name not in partitions(table)]
    keys = [f"`{name}` {'DATE' if name == PARTITION else 'STRING'}" for name in partitions(table)]
    name = f"`{database}`.`{table}`"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({', '.join([*map(_declared, own), *keys])}) "
        # an overwrite replaces the partitions that it has rows for, whatever the session's setting
        f"USING parquet OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({', '.join(f'`{k}`' for k in partitions(table))})"
    )
    return name


def _value(field: StructField, table: str) -> Column:
    """A column in its declared type. File tables do not enforce NOT NULL, so a missing value is an error here."""
    value = F.col(field.name).cast(field.dataType)
    if field.nullable:
        return value.alias(field.name)
    missing = F.raise_error(F.lit(f"{table}.{field.name} must not be NULL")).cast(field.dataType)
    return F.coalesce(value, missing).alias(field.name)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns and types of the declared result table."""
    return df.select(*[_value(field, table) for field in schemas.RESULT_SCHEMAS[table].fields])


def _write(
    spark: SparkSession, database: str, table: str, df: DataFrame, batch: str | None = None
) -> Row:
    """``rows`` and ``keys`` of what was written: how many rows and which partitions, counted by the write itself.

    The metrics are taken by the tasks that write, behind the last shuffle, so a task that is repeated counts once.
    """
    name = create_table(spark, database, table)
    dated = conform(df, table).withColumn(PARTITION, F.to_date(schemas.TIME_COLUMN[table]))
    if batch is not None:
        dated = dated.withColumn(BATCH, F.lit(batch))
    keys = partitions(table)
    rows = dated.select(*[c for c in dated.columns if c not in keys], *keys)
    observed = Observation()
    # one file per partition; AQE merges small ones and splits what is too large for one file
    counted = rows.hint("rebalance", *keys).observe(
        observed,
        F.count("*").alias("rows"),
        F.collect_set(F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit(NULL_PARTITION)) for k in keys])).alias("keys"),
    )
    counted.write.insertInto(name, overwrite=True)
    return Row(rows=observed.get["rows"], keys=observed.get["keys"])


def refresh_table(spark: SparkSession, database: str, table: str, df: DataFrame, batch: str | None = None) -> int:
    """Replace the contents of a table; the number of its rows.

    The new partitions replace the old ones as one commit, then those that have no row any more are dropped. A refresh
    that fails before its commit changes nothing; one that fails after it can be repeated.
    """
    written = _write(spark, database, table, df, batch)
    kept = set(written.keys)
    drop_partitions(spark, database, table, lambda values: "/".join(values.values()) not in kept)
    return written.rows


def refresh_dates(spark: SparkSession, database: str, table: str, df: DataFrame, batch: str | None = None) -> int:
    """Replace the partitions that ``df`` has rows for, as one commit, and leave all others; the number of its rows."""
    return _write(spark, database, table, df, batch).rows


def append_rows(spark: SparkSession, database: str, table: str, df: DataFrame) -> int:
    """Add rows to a table such as the history of quality checks; how many they are.

    Tables that are appended to have a partition for each append, so that several at a time do not meet in one folder.
    """
    if BATCH not in partitions(table):
        raise ValueError(f"{table} has no partition for an append; refresh it, or its dates")
    return _write(spark, database, table, df, f"run-{uuid.uuid4().hex}").rows


def drop_partitions(
    spark: SparkSession, database: str, table: str, drop: Callable[[dict[str, str]], bool]
) -> int:
    """Drop the partitions whose values, by name, ``drop`` is true for; how many they are.

    The driver handles the names of partitions only.
    """
    name = f"`{database}`.`{table}`"
    old = []
    for row in spark.sql(f"SHOW PARTITIONS {name}").toLocalIterator():
        values = {key: unquote(value) for key, value in (part.split("=", 1) for part in row[0].split("/"))}
        if drop(values):
            old.append(", ".join(f"`{key}` = {_literal(value)}" for key, value in values.items()))
    for first in range(0, len(old), DROPPED_AT_ONCE):
        specs = ", ".join(f"PARTITION ({spec})" for spec in old[first : first + DROPPED_AT_ONCE])
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {specs}")
    return len(old)


def _literal(value: str) -> str:
    if value == NULL_PARTITION:
        return "NULL"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def side_by_side(write: Callable[[str, DataFrame], None], results: Mapping[str, DataFrame]) -> None:
    """Write several tables at a time, since each is too small to fill a cluster; raises if one of them fails."""
    with ThreadPoolExecutor(max_workers=max(len(results), 1)) as pool:
        writes = [pool.submit(write, table, df) for table, df in results.items()]
    for job in writes:
        job.result()


def refresh_tables(spark: SparkSession, database: str, results: Mapping[str, DataFrame]) -> None:
    side_by_side(lambda table, df: refresh_table(spark, database, table, df), results)


def with_partitions(spark: SparkSession, database: str, table: str) -> DataFrame:
    """All columns of a table, the partition columns among them."""
    return spark.table(f"`{database}`.`{table}`")


def between(df: DataFrame, time: str, since, until) -> DataFrame:
    """Rows from ``since`` and before ``until``; the range is also put on the dates, so others are not read."""
    if since is not None:
        start = as_of_time(since)
        df = df.where((F.col(time) >= start) & (F.col(PARTITION) >= F.to_date(start)))
    if until is not None:
        end = as_of_time(until)
        df = df.where((F.col(time) < end) & (F.col(PARTITION) <= F.to_date(end)))
    return df


def read_table(spark: SparkSession, database: str, table: str, since=None, until=None) -> DataFrame | None:
    """The declared columns of a table, or None if the catalog has no such table."""
    if not exists(spark, database, table):
        return None
    rows = between(with_partitions(spark, database, table), schemas.TIME_COLUMN[table], since, until)
    return rows.select(*schemas.RESULT_SCHEMAS[table].fieldNames())


def read_newest(spark: SparkSession, database: str, table: str, rows: int | None) -> DataFrame | None:
    """The newest dates of a table that hold ``rows`` rows between them; with None, all dates.

    Rows are counted by date from file footers. No date is empty, so at most ``rows`` counts reach the driver.
    """
    if not exists(spark, database, table):
        return None
    df = with_partitions(spark, database, table)
    counts = [] if rows is None else df.groupBy(PARTITION).count().orderBy(F.desc(PARTITION)).limit(rows).collect()
    held = 0
    for row in counts:
        held += row["count"]
        if held >= rows and row[PARTITION] is not None:
            df = df.where(F.col(PARTITION) >= F.lit(row[PARTITION]))
            break
    return df.select(*schemas.RESULT_SCHEMAS[table].fieldNames())


def clean_up(
    spark: SparkSession, database: str, as_of=None, days: int = settings.RETENTION_DAYS, tables: list[str] | None = None
) -> list[str]:
    """Drop the partitions of all tables that lie wholly before ``as_of`` less ``days``; the tables that had any.

    Rows of the date that the limit falls into stay, and so do rows without a time.
    """
    cutoff = as_of_time(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    oldest = spark.range(1).select(F.to_date(cutoff)).first()[0].isoformat()

    def out_of_date(values: dict[str, str]) -> bool:
        return values[PARTITION] != NULL_PARTITION and values[PARTITION] < oldest

    found = existing(spark, database, *(tables or schemas.RESULT_SCHEMAS))
    return [table for table in found if drop_partitions(spark, database, table, out_of_date)]


def scan_result_table(df: DataFrame, table: str) -> DataFrame:
    """All columns of a result table in time order."""
    time = schemas.TIME_COLUMN[table]
    return df.orderBy(time, *[name for name in schemas.PRESENTATION_ORDER[table] if name != time])


def write_jdbc(
    df: DataFrame, table: str, url: str, properties: Mapping[str, str], refresh: bool = True, writers: int = 8
) -> None:
    """Write a result table to a database.

    With ``refresh`` the rows replace the table's contents but keep its definition. Partitions are written in
    parallel and commit one by one, so a reader can see a part of them.
    """
    mode = "overwrite" if refresh else "append"
    writer = conform(df, table).repartition(writers).write.mode(mode).option("truncate", str(refresh).lower())
    writer.option("batchsize", "10000").jdbc(url, table, properties=dict(properties))
