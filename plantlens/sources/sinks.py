"""Sinks (S2-S9): part-file writes, timestamp encodings, table registration.

No data passes through the driver; every sink computes its input once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlens.functions.timestamps import iso_utc_ms, native_ms
from plantlens.sources import staging

RAW_PREFIX = "raw_"
CATALOG_PARTITIONS = "spark.sql.hive.manageFilesourcePartitions"


def raw_name(name: str) -> str:
    """Force the ``raw_`` prefix once."""
    return name if name.startswith(RAW_PREFIX) else f"{RAW_PREFIX}{name}"


def encode_timestamps(df: DataFrame, mode: str = "iso") -> DataFrame:
    """Every timestamp column either as ISO-8601 UTC text with
    milliseconds and 'NaT' for missing (``iso``, default), or as a real
    timestamp floored to milliseconds (``native``)."""
    if mode not in ("iso", "native"):
        raise ValueError(f"timestamp mode must be 'iso' or 'native', not {mode!r}")
    enc = iso_utc_ms if mode == "iso" else native_ms
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(enc(df[f.name]).alias(f.name))
        else:
            cols.append(df[f.name])
    return df.select(*cols)


ROWS_PER_FILE = 2_000_000


def write_parts(df: DataFrame, path: str, num_files: int | None = None, rows_per_file: int = ROWS_PER_FILE,
                mode: str = "overwrite") -> None:
    """Parquet part files, in one pass over ``df``.

    By default the tasks that compute the rows write them, a new file after
    every ``rows_per_file`` rows.  ``num_files`` (the caller's choice) deals the
    rows round robin into exactly that many tasks, hence at most as many files."""
    if num_files is not None:
        df = df.repartition(num_files)
        df.write.mode(mode).parquet(path)
    else:
        df.write.mode(mode).option("maxRecordsPerFile", rows_per_file).parquet(path)


def save_raw(df: DataFrame, name: str, base_path: str, num_files: int | None = None,
             timestamps: str = "iso") -> str:
    """The raw sink: encode timestamps, prefix the name, write parts
    under ``base_path``.  Returns the folder written."""
    out = f"{base_path.rstrip('/')}/{raw_name(name)}"
    write_parts(encode_timestamps(df, timestamps), out, num_files)
    return out


def save_table(spark: SparkSession, df: DataFrame, name: str, database: str | None = None,
               path: str | None = None, comment: str | None = None,
               partition_by: str | None = None, catalog: str | None = None) -> str:
    """Create-or-replace a parquet table (optionally at an explicit
    path and partitioned by a column), creating the database if missing, and
    attach a comment.  Before a partitioned write the rows are rebalanced by the
    partition column: AQE splits a large partition and merges small ones by
    their measured size, so files follow the data.  ``catalog`` gives a three-part
    name for a configured catalog.  When a path is given the database is located beside it, so
    nothing is written under the driver's working folder.  Returns the
    qualified table name.

    A table with a path is replaced atomically: the rows are written to a new
    version folder below the path, then a pointer is renamed over the old one
    (``staging.read_current`` follows it) and the catalog entry moved to it.  A
    write that fails leaves the old table as it was.  The version before is
    kept for jobs that still read it; older ones are deleted.  A table without a
    path is replaced in place by Spark."""
    qualified = f"`{name}`"
    if database:
        db = f"`{catalog}`.`{database}`" if catalog else f"`{database}`"
        location = ""
        if path:
            parent = path.rstrip("/").rsplit("/", 1)[0]
            location = f" LOCATION '{parent}/_databases/{database}.db'"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{location}")
        qualified = f"{db}.`{name}`"
    rows = df.hint("rebalance", F.col(partition_by)) if partition_by else df
    if path is None:
        w = rows.write.mode("overwrite").format("parquet")
        (w.partitionBy(partition_by) if partition_by else w).saveAsTable(qualified)
    else:
        version, before = staging.new_version(path), staging.current_version(spark, path)
        w = rows.write
        (w.partitionBy(partition_by) if partition_by else w).parquet(version)
        staging.point_to(spark, path, version)
        _register(spark, qualified, df, version, partition_by)
        staging.drop_versions(spark, path, {version, *([before] if before else [])})
    if comment is not None:
        text = comment.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {qualified} SET TBLPROPERTIES ('comment' = '{text}')")
    return qualified


def _register(spark: SparkSession, qualified: str, df: DataFrame, version: str, partition_by: str | None) -> None:
    """Let the catalog entry name the version.  Where columns and partitioning
    are as before only its location changes, in one catalog update; else the
    entry (never its files) is made anew."""
    names = [c for c in df.columns if c != partition_by] + ([partition_by] if partition_by else [])
    wanted = [(n, df.schema[n].dataType) for n in names]
    parts = [partition_by] if partition_by else []
    same = spark.catalog.tableExists(qualified)
    if same:
        same = ([(f.name, f.dataType) for f in spark.table(qualified).schema.fields] == wanted
                and [c.name for c in spark.catalog.listColumns(qualified) if c.isPartition] == parts)
    if same:
        spark.sql(f"ALTER TABLE {qualified} SET LOCATION '{version}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {qualified}")
        columns = df.select(names)._jdf.schema().toDDL().replace(" NOT NULL", "")
        by = f" PARTITIONED BY (`{partition_by}`)" if partition_by else ""
        listed = spark.conf.get(CATALOG_PARTITIONS)
        try:
            # partitions are found in the version's folders, so they change with it
            spark.conf.set(CATALOG_PARTITIONS, "false")
            spark.sql(f"CREATE TABLE {qualified} ({columns}) USING parquet{by} LOCATION '{version}'")
        finally:
            spark.conf.set(CATALOG_PARTITIONS, listed)
    spark.catalog.refreshTable(qualified)
