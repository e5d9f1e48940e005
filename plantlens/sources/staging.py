"""Tables written on the way: shared staging and the versions of a saved table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from plantlens.session import checkpoint_dir

POINTER = "_current"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read back: its
    rows and their order of tasks are then fixed, whatever is lost later."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/plantlens-staged/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def new_version(base: str) -> str:
    """A folder name for the next version of the table below ``base``."""
    return f"{base.rstrip('/')}/version-{uuid.uuid4().hex}"


def current_version(spark: SparkSession, base: str) -> str | None:
    """The folder that ``base`` points to, or None for a table never saved."""
    base = base.rstrip("/")
    fs, pointer = _system(spark, base), _path(spark, f"{base}/{POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return f"{base}/" + spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def point_to(spark: SparkSession, base: str, version: str) -> None:
    """Let ``base`` point to a finished version: the new pointer is written aside
    and renamed over the old one, so a reader sees either, never a part."""
    base = base.rstrip("/")
    fs, aside = _system(spark, base), f"{base}/{POINTER}-{uuid.uuid4().hex}"
    out = fs.create(_path(spark, aside), False)
    try:
        out.write(bytearray(version.rsplit("/", 1)[1].encode()))
    finally:
        out.close()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    rename = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    rename[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(_path(spark, aside)), fs.makeQualified(_path(spark, f"{base}/{POINTER}")), rename)


def drop_versions(spark: SparkSession, base: str, keep: set[str]) -> None:
    """Delete the versions below ``base`` that are not in ``keep``."""
    base = base.rstrip("/")
    fs = _system(spark, base)
    kept = {v.rsplit("/", 1)[1] for v in keep}
    for status in fs.listStatus(_path(spark, base)):
        name = status.getPath().getName()
        if name.startswith("version-") and name not in kept:
            fs.delete(status.getPath(), True)


def read_current(spark: SparkSession, base: str) -> DataFrame:
    """The current version of a saved table, without any catalog."""
    version = current_version(spark, base)
    if version is None:
        raise FileNotFoundError(f"no table was saved at {base}")
    return spark.read.parquet(version)


def latest_partition(spark: SparkSession, folder: str, column: str) -> str | None:
    """The greatest value of a partition column of the table in ``folder``, from
    the names of its partition folders: one listing, one name a partition, no
    data file is opened.  Null partitions do not count; None without any."""
    fs = _system(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(_path(spark, folder)) if s.isDirectory()]
    values = [n.split("=", 1)[1] for n in names if n.startswith(f"{column}=")]
    return max((v for v in values if v != "__HIVE_DEFAULT_PARTITION__"), default=None)
