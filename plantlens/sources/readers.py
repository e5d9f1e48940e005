"""Parquet sources (S1) and read-side schema conformance."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlens.functions.timestamps import parse_iso_timestamp

FOOTER_THREADS = 16


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table: ``{sf_dir}/{name}.parquet`` (a file or a directory)."""
    return spark.read.option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/{name}.parquet")


def read_parquet_dir(spark: SparkSession, path: str, schema: T.StructType | None = None,
                     lenient: bool = False) -> DataFrame:
    """Read every ``*.parquet`` part under a directory.

    With a declared schema the columns are conformed to it: integer widths
    are cast, and timestamp columns that were written as ISO text (the
    sink's default mode, missing values as ``'NaT'``) are parsed.
    """
    df = spark.read.option("pathGlobFilter", "*.parquet").parquet(path)
    return conform(df, schema, lenient) if schema is not None else df


def read_mixed_dir(spark: SparkSession, path: str, schema: T.StructType, lenient: bool = False) -> DataFrame:
    """S1 over part files of different types: integers of any width, timestamps
    as ISO text in some files and native in others, columns in any order.

    The files are grouped by the schema in their footers (read through Spark's
    file system, many at a time), each group is one scan conformed to the
    declared ``schema``, and the scans are united.  Only file names and schemas
    reach the driver."""
    names = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
             .load(path).select("path"))
    files = sorted(r.path for r in names.collect())
    if not files:
        return spark.createDataFrame([], schema)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def written_as(file: str) -> str:
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(file), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        try:
            return reader.getFileMetaData().getSchema().toString()
        finally:
            reader.close()

    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        kinds = list(pool.map(written_as, files))
    groups: dict[str, list[str]] = {}
    for file, kind in zip(files, kinds):
        groups.setdefault(kind, []).append(file)
    scans = [conform(spark.read.parquet(*some), schema, lenient) for some in groups.values()]
    return reduce(DataFrame.unionByName, scans)


def conform(df: DataFrame, schema: T.StructType, lenient: bool = False) -> DataFrame:
    """Project ``df`` onto ``schema``: same names and order, declared types.

    Strict by default: a missing column raises at once, and a value that does
    not fit its declared type fails the job that reads it.  ``lenient=True``
    reads older files: missing columns and unfit values become NULL.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing and not lenient:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    cols = []
    for f in schema.fields:
        if f.name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] == f.dataType:
            cols.append(F.col(f.name))
        else:
            value = F.col(f.name)
            if isinstance(f.dataType, T.TimestampType) and isinstance(have[f.name], T.StringType):
                fit = parse_iso_timestamp(value)
                absent = value.isNull() | (value == "NaT")
            else:
                fit = value.try_cast(f.dataType)
                absent = value.isNull()
            if not lenient:
                wrong = F.concat(F.lit(f"{f.name}: value does not fit {f.dataType.simpleString()}: "), value.cast("string"))
                fit = F.when(fit.isNotNull() | absent, fit).otherwise(F.raise_error(wrong).cast(f.dataType))
            cols.append(fit.alias(f.name))
    return df.select(*cols)
