"""Stored tables: scans, loads, work copies and run markers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Hashes and keys are hexadecimal text, which zstd halves and the default leaves as it is.
COMPRESSED = ("compression", "zstd")
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def read_parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """The shared folder for work copies, named by ``spark.checkpoint.dir``.

    Only a local session may go without it; executors of a cluster could not
    read a folder of one machine.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="martflow-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the work folder."""
    return f"{work_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write a frame to the shared work folder and read it back.

    Cuts the lineage with files that outlive executors, and lets a plan that
    feeds several results run once.
    """
    spark = df.sparkSession
    folder = new_folder(spark, "stage")
    with shuffles_removed(spark):
        df.write.option(*COMPRESSED).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def new_database(spark: SparkSession, label: str = "mart") -> str:
    """A fresh database below the work folder."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_folder(spark, name)}'")
    return name


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def table_property(spark: SparkSession, table: str, name: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == name).collect()
    return rows[0]["value"] if rows else None


def set_table_property(spark: SparkSession, table: str, name: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{name}' = '{value}')")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def by_partition(
    df: DataFrame, columns: Sequence[str], order_by: Sequence[Column | str] = ()
) -> DataFrame:
    """Gather the rows of a table partition into few files, each sorted.

    Spark merges small partitions and splits large ones, so a partition with
    most of the rows is still written by many tasks.
    """
    gathered = df.hint("rebalance", *columns)
    return gathered.sortWithinPartitions(*columns, *order_by) if order_by else gathered


def initial_load(
    df: DataFrame,
    table: str,
    cluster_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    order_by: Sequence[Column | str] = (),
) -> None:
    """Create or replace a table, with its schema, partitioned or clustered.

    ``order_by`` sorts the rows of each file of a partitioned table.
    """
    if partition_by:
        df = by_partition(df, partition_by, order_by)
    writer = df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if fmt == "parquet":
        writer = writer.option(*COMPRESSED)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    elif cluster_by:
        writer = writer.clusterBy(*cluster_by)
    with shuffles_removed(df.sparkSession):
        writer.saveAsTable(table)


def materialized_view(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    comment: str | None = None,
    cluster_by: Sequence[str] = (),
    properties: Mapping[str, str] | None = None,
) -> None:
    """A fully recomputed table with a comment and table properties."""
    initial_load(df, table, cluster_by)
    if comment:
        spark.sql(f"COMMENT ON TABLE {table} IS :text", args={"text": comment})
    if properties:
        pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def append(df: DataFrame, table: str) -> None:
    df.write.mode("append").saveAsTable(table)


def drop(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def mark_run(spark: SparkSession, table: str, at: Column | None = None) -> None:
    """Append one row that tells other systems a run has ended."""
    moment = F.current_timestamp() if at is None else at
    append(spark.range(1).select(moment.alias("date_create")), table)


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Let overwrites replace only the partitions they write."""
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the shuffle files of a write when it ends, not when the driver collects garbage.

    A load of several steps then holds the shuffles of one step on disk, not of all.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


@contextmanager
def shuffled_by_part_of_key(spark: SparkSession) -> Iterator[None]:
    """Let joins take sides as they are that were shuffled alike by a part of the key."""
    before = spark.conf.get(ALL_KEYS)
    spark.conf.set(ALL_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(ALL_KEYS, before)


@contextmanager
def temp_view(df: DataFrame, name: str) -> Iterator[str]:
    """Register a view for the length of a block."""
    df.createOrReplaceTempView(name)
    try:
        yield name
    finally:
        df.sparkSession.catalog.dropTempView(name)
