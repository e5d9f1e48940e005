"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlens.session import checkpoint_dir

# Words as the contracts define them: runs of anything but space, tab, line
# feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

HEAVY_GROUPS = 10_000            # most groups that may be broadcast
LIGHT_ROWS = 1_000               # a group up to this size is never heavy


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pinned(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder the session
    names, so a lost executor costs a re-read and not the whole job."""
    spark = df.sparkSession
    folder = checkpoint_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


# ------------------------------------------------------- rows with any columns
def without_maps(value: Column, kind: T.DataType) -> Column:
    """``value`` with every map in it as an array of its entries, sorted by key:
    maps cannot be hashed, grouped or ordered."""
    if isinstance(kind, T.MapType):
        entries = F.array_sort(F.map_entries(value)) if _ordered(kind.valueType) else F.map_entries(value)
        return F.transform(entries, lambda e: F.struct(
            e["key"].alias("key"), without_maps(e["value"], kind.valueType).alias("value")))
    if isinstance(kind, T.StructType) and not _ordered(kind):
        inner = F.struct(*[without_maps(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(value.isNotNull(), inner)
    if isinstance(kind, T.ArrayType) and not _ordered(kind):
        return F.transform(value, lambda x: without_maps(x, kind.elementType))
    return value


def with_maps(value: Column, kind: T.DataType) -> Column:
    """The value that :func:`without_maps` took apart."""
    if isinstance(kind, T.MapType):
        return F.map_from_entries(F.transform(value, lambda e: F.struct(
            e["key"].alias("key"), with_maps(e["value"], kind.valueType).alias("value"))))
    if isinstance(kind, T.StructType) and not _ordered(kind):
        inner = F.struct(*[with_maps(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(value.isNotNull(), inner)
    if isinstance(kind, T.ArrayType) and not _ordered(kind):
        return F.transform(value, lambda x: with_maps(x, kind.elementType))
    return value


def _ordered(kind: T.DataType) -> bool:
    """Has the type no map in it?"""
    if isinstance(kind, T.StructType):
        return all(_ordered(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _ordered(kind.elementType)
    return not isinstance(kind, T.MapType)


def whole_row(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one struct without maps, whatever their names."""
    return F.struct(*[without_maps(docs[f.name], f.dataType).alias(f.name) for f in docs.schema.fields])


def row_columns(docs: DataFrame, row: str = "row") -> list[Column]:
    """The columns of ``docs`` back out of its :func:`whole_row`."""
    return [with_maps(F.col(row)[f.name], f.dataType).alias(f.name) for f in docs.schema.fields]


class Scratch:
    """Intermediate tables of one operator, written as compressed Parquet below
    the shared folder and read again, which cuts lineage like a checkpoint.
    A table that later steps no longer read is dropped at once, so an
    operator's disk is its live tables and not all it ever made."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.paths = spark, shared_folder(spark, name), {}

    def keep(self, df: DataFrame, dictionary: bool = True) -> DataFrame:
        """``dictionary=False`` for long values that never repeat: no attempt is
        made to code them."""
        path = f"{self.folder}/{len(self.paths)}"
        df.write.option("compression", "zstd").option("parquet.enable.dictionary", str(dictionary).lower()).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[path] = out
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that ``keep`` returned; nothing may read them any more."""
        for path, df in self.paths.items():
            if any(df is t for t in tables):
                where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def join_groups(rows: DataFrame, table: DataFrame, on: list[str], total: int) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row for each value
    of ``on`` (null equals null) and its number of rows in ``size``.  Heavy groups
    are broadcast; by their share of the rows they are at most HEAVY_GROUPS."""
    limit = max(LIGHT_ROWS, total // HEAVY_GROUPS)
    right = table.select(*[F.col(c).alias(f"{c}_of_group") for c in on], *[c for c in table.columns if c not in on])
    heavy, light = right.filter(F.col("size") > limit), right.filter(F.col("size") <= limit)

    def same(left: DataFrame, part: DataFrame) -> Column:
        tests = [left[c].eqNullSafe(part[f"{c}_of_group"]) for c in on]
        return tests[0] if len(tests) == 1 else tests[0] & tests[1]

    few = F.broadcast(heavy)
    in_heavy = rows.join(few, same(rows, few))
    rest = rows.join(few, same(rows, few), "left_anti")
    return in_heavy.union(rest.join(light, same(rest, light))).drop(*[f"{c}_of_group" for c in on])


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def split_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def byte_chunks(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer row stands alone."""
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def bucket_of(text_of_id: str, modulus: int):
    """``crc32(id as text) mod modulus`` as a Column; null for a null id."""
    return F.crc32(F.col(text_of_id).cast("string").cast("binary")) % modulus


def hash_sample(df: DataFrame, key: str, kind: str, rows: int) -> DataFrame:
    """About ``rows`` rows of each value of ``kind`` (all, where it has fewer): those
    whose hash of ``key`` lies below the share that makes so many.  The kinds are
    counted first by a partial aggregate; no kind's rows meet in one task, and
    the same keys are drawn again in any partitioning."""
    sizes = df.groupBy(F.col(kind).alias("_kind")).agg(F.count("*").alias("_size"))
    drawn = df.join(sizes, df[kind] == sizes["_kind"])
    place = F.shiftrightunsigned(F.xxhash64(F.lit(11), F.col(key)), 24) / float(1 << 40)
    return drawn.filter(place * F.col("_size") < rows).select(*[df[c] for c in df.columns])


def one_thread() -> None:
    """Numeric libraries inside a task stay on the task's own core."""
    os.environ.setdefault("OMP_NUM_THREADS", "1")
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a Spark context, so that
    tasks import it wherever the driver was started."""
    context = spark.sparkContext
    if getattr(context, "_plantlens_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="plantlens-code-"), f"{root.name}.zip")      # on the driver, for Spark to send
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._plantlens_shipped = True


# ------------------------------------------------- files in the shared folder
def _located(uri: str):
    from pyarrow import fs

    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri.removeprefix("file:")


def open_output(uri: str):
    """Stream into a new file of the shared store (any URI Arrow knows)."""
    system, path = _located(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path, compression=None)          # not by the name's ending


def open_input(uri: str):
    system, path = _located(uri)
    return system.open_input_stream(path, compression=None)


# ------------------------------------------------------------ ranges of an id
def id_cuts(df: DataFrame, id_col: str, parts: int) -> list[int]:
    """At most ``parts - 1`` ascending ids of ``df`` that cut it into ranges of
    about as many rows each.  Only the cuts, one per range, reach the driver."""
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(F.col(id_col).cast("long"), shares, max(10_000, 20 * parts)).alias("c")).first().c
    return sorted(set(found or []))


def range_of(id_col, cuts: list[int]):
    """Number of cuts below the id, as a Column; null ids fall in range 0.
    Looks through two levels of about sqrt(cuts) entries, not all cuts."""
    if not cuts:
        return F.lit(0)
    step = int(len(cuts) ** 0.5) + 1
    fine = F.lit(cuts)
    coarse = F.lit(cuts[step - 1::step] or [cuts[-1]])
    skipped = F.size(F.filter(coarse, lambda c: c < id_col)) * step if len(cuts) >= step else F.lit(0)
    inside = F.size(F.filter(F.slice(fine, F.least(skipped + 1, F.lit(len(cuts) + 1)), step), lambda c: c < id_col))
    return F.when(id_col.isNull(), 0).otherwise(F.least(skipped + inside, F.lit(len(cuts)))).cast("int")
