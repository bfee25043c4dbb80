"""Tables of the session catalog over Parquet files: raw lake layout, replacement, refresh, buckets, loads, reads."""

from __future__ import annotations

import time
import uuid
import zlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.functions import epoch_ns
from earshot.operators.joins import MONTH
from earshot.session import file_system, prepare

# Folder and file of each raw dataset below the lake root.
RAW_LAYOUT = {
    "music_charts": ("music_charts", "music_charts.parquet"),
    "music_charts_historical": ("music_charts_historical", "music_charts_historical.parquet"),
    "podcast_shows": ("podcast_reviews", "podcast_shows.parquet"),
    "podcast_reviews": ("podcast_reviews", "podcast_reviews.parquet"),
    "podcast_charts": ("podcast_charts", "podcast_charts.parquet"),
}


def raw_path(root: str, dataset: str) -> str:
    """<root>/raw/<folder>/<file>.parquet for any URI Spark can write to."""
    folder, name = RAW_LAYOUT[dataset]
    return f"{root.rstrip('/')}/raw/{folder}/{name}"


def raw_form(df: DataFrame) -> DataFrame:
    """Timestamps as bigint nanoseconds, the form the raw tables hold them in."""
    moments = {f.name for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    own = {c: F.col(f"`{c}`") for c in df.columns}
    return df.select(*[epoch_ns(own[c]).alias(c) if c in moments else own[c] for c in df.columns])


# ---- tables of the session catalog ----------------------------------------------
#
# A table's name stands in the catalog; its files lie in a folder of their own per
# version, below the folder of its database. Which version is current is the table's
# LOCATION, so changing it is one change in the catalog. Names outlive the session
# where the catalog does (a metastore).

VERSIONS_KEPT = 2


def create_database(spark: SparkSession, name: str, folder: str) -> str:
    """A database whose tables lie below `folder`; it may be there already, at the same place."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{folder}'")
    return name


def table_folder(spark: SparkSession, table: str) -> str:
    """The folder that holds the versions of a table, by default below its database's."""
    database, name = table.split(".")
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}"


@dataclass(frozen=True)
class Version:
    """A written version of a table, not yet the current one."""

    table: str
    path: str
    frame: DataFrame
    layout: str = ""


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def write_version(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    folder: str | None = None,
) -> Version:
    """Write a new version of a table; the current one stays as it is.

    A layout needs one shuffle by the partition columns. It is a rebalance: AQE
    cuts a partition value that holds too much data into several tasks and joins
    small ones, so a hot day is neither one task nor one giant file. Rows are
    sorted inside each file by the cluster columns, which gives row groups
    narrow min/max ranges to skip by.
    """
    spark = df.sparkSession
    keys = [F.col(c) for c in (partition_by or cluster_by)]
    arranged = df.hint("rebalance", *keys) if keys else df
    if cluster_by:
        arranged = arranged.sortWithinPartitions(*partition_by, *cluster_by)
    writer = arranged.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    path = new_version(folder or table_folder(spark, table))
    writer.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path).select(*[F.col(f"`{c}`") for c in df.columns])
    layout = f"PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    return Version(table, path, stored, layout)


def write_buckets(df: DataFrame, table: str, by: str, buckets: int) -> Version:
    """A new version in `buckets` buckets of one column, sorted by it in each.

    What groups or joins by that column later needs no shuffle. A bucket is one task
    there, so this is for columns of which no value holds a large part of the rows.
    """
    spark = df.sparkSession
    path = new_version(table_folder(spark, table))
    written = f"{table.split('.')[0]}.{quoted(path.rsplit('/', 1)[1].replace('-', '_'))}"
    dealt = df.repartition(buckets, by)
    dealt.write.format("parquet").bucketBy(buckets, by).sortBy(by).option("path", path).saveAsTable(written)
    # the files stay; the table gets them under its own name
    spark.sql(f"DROP TABLE {written}")
    layout = f"CLUSTERED BY ({quoted(by)}) SORTED BY ({quoted(by)}) INTO {buckets} BUCKETS"
    return Version(table, path, spark.read.schema(df.schema).parquet(path), layout)


def new_version(folder: str) -> str:
    return f"{folder.rstrip('/')}/version-{time.time_ns()}-{uuid.uuid4().hex}"


# The property that holds how a table's files are laid out.
LAYOUT = "earshot.layout"


def publish(*versions: Version) -> None:
    """Make written versions the current ones: one change of the catalog for each.

    The version before stays on disk for readers that are still on it; older ones go.
    A table whose columns or layout are others than before is defined anew.
    """
    for version in versions:
        spark = version.frame.sparkSession
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in version.frame.schema.fields)
        definition = f"{columns} {version.layout}"
        current = None
        if spark.catalog.tableExists(version.table):
            current = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {version.table}").collect()}.get(LAYOUT)
        if current == str(zlib.crc32(definition.encode())):
            spark.sql(f"ALTER TABLE {version.table} SET LOCATION '{version.path}'")
        else:
            spark.sql(f"DROP TABLE IF EXISTS {version.table}")
            with partitions_in_folders(spark):
                spark.sql(
                    f"CREATE TABLE {version.table} ({columns}) USING parquet {version.layout} "
                    f"LOCATION '{version.path}' TBLPROPERTIES ('{LAYOUT}' = '{zlib.crc32(definition.encode())}')"
                )
        spark.catalog.refreshTable(version.table)
    for version in versions:
        drop_old_versions(version)


@contextmanager
def partitions_in_folders(spark: SparkSession) -> Iterator[None]:
    """Tables made here find their partitions in their folder, so that a new LOCATION is all that changes."""
    key = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def drop_old_versions(version: Version) -> None:
    files, folder = file_system(version.frame.sparkSession, version.path.rsplit("/", 1)[0])
    found = [entry.getPath() for entry in files.listStatus(folder) if entry.getPath().getName().startswith("version-")]
    # names begin with the time
    for old in sorted(found, key=lambda path: path.getName())[:-VERSIONS_KEPT]:
        if old.getName() != version.path.rsplit("/", 1)[1]:
            files.delete(old, True)


def write_table(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    folder: str | None = None,
) -> DataFrame:
    """Replace a table ("database.name"), optionally partitioned and clustered, and
    return the stored table: what is built on it starts from its files.

    The new version is written next to the current one and then takes its place,
    so a write that fails leaves the table as it was.
    """
    version = write_version(df, table, partition_by, cluster_by, folder)
    publish(version)
    return version.frame


def location_of(spark: SparkSession, table: str) -> str:
    """The folder of the current version."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return described.first()["data_type"]


def refresh_partitions(df: DataFrame, table: str, partition_by: Sequence[str], cluster_by: Sequence[str] = ()) -> DataFrame:
    """Replace those partitions of a table that `df` holds rows of; the others are not touched.

    Spark's dynamic overwrite writes the new files aside and puts them in place when
    all are written. Returns the whole table.
    """
    spark = df.sparkSession
    stored = spark.table(table)
    if set(df.columns) != set(stored.columns):
        raise ValueError(f"{table}: columns {sorted(df.columns)} are not those of the table")
    arranged = df.select(*[F.col(f"`{c}`") for c in stored.columns]).hint("rebalance", *[F.col(c) for c in partition_by])
    if cluster_by:
        arranged = arranged.sortWithinPartitions(*partition_by, *cluster_by)
    writer = arranged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(location_of(spark, table))
    spark.catalog.refreshTable(table)
    return spark.table(table)


def read_table(spark: SparkSession, source: str) -> DataFrame:
    """A table by name ("database.name"), or the Parquet files at a path."""
    return prepare(spark).read.parquet(source) if "/" in source else prepare(spark).table(source)


def read_table_by_month(spark: SparkSession, source: str) -> DataFrame:
    """A mart in month order: tables keep no order, so it is made on read."""
    return read_table(spark, source).orderBy(MONTH)


def load_raw(
    spark: SparkSession,
    source: str,
    target: str,
    partition_by: str | None = None,
    cluster_by: Sequence[str] = (),
) -> int:
    """Copy a Parquet input (or a table) into a raw table, replacing it; returns its rows.

    The count comes from the file footers of the new table.
    """
    raw = read_table(spark, source)
    return write_table(raw, target, [partition_by] if partition_by else [], cluster_by).count()
