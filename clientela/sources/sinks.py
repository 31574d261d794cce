"""Outputs: result tables, CSV exports and saved models."""

from __future__ import annotations

import re
import uuid
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.ml.util import MLReader, MLWritable
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clientela.functions.storage import materialise

VERSION_PREFIX = "version="


ROWS, POINTERS = "rows", "pointers"


def publish_parquet(df: DataFrame, path: str) -> DataFrame:
    """Replace a published table and return it as written.

    The rows go to a folder of their own under ``path``; then one small file names that
    folder. Who reads the table by ``read_published`` sees the last publication that was finished: one
    that fails or is killed on the way leaves the table as it was. Older rows stay until they are
    removed by hand.
    """
    spark = df.sparkSession
    last = _last_pointer(spark, path)
    number = 1 if last is None else last.number + 1
    # A try that was given up may have left rows: its folder is not used again.
    rows = f"{ROWS}/{number:08d}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(f"{path}/{rows}")
    pointer = spark.createDataFrame([(number, rows)], POINTER).coalesce(1)
    # Appended, so no reader ever finds no pointer at all.
    pointer.write.mode("append").parquet(f"{path}/{POINTERS}")
    return spark.read.schema(df.schema).parquet(f"{path}/{rows}")


POINTER = "number long, rows string"


def _last_pointer(spark: SparkSession, path: str):
    try:
        pointers = spark.read.schema(POINTER).parquet(f"{path}/{POINTERS}")
    except AnalysisException:
        return None
    return pointers.orderBy(F.desc("number"), F.desc("rows")).first()


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last finished publication."""
    last = _last_pointer(spark, path)
    if last is None:
        raise FileNotFoundError(f"nothing published under {path}")
    return spark.read.parquet(f"{path}/{last.rows}")


def publish_table(df: DataFrame, table: str) -> DataFrame:
    df.write.mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def put_partitions(df: DataFrame, path: str, *keys: str) -> DataFrame:
    """Put the rows into the partitions of their keys (country and period of a run, say).

    A partition that has rows in ``df`` is replaced as a whole, the others stay, so doing it
    twice leaves one copy. Spark moves the new files into place when all of them are written.
    """
    writer = df.write.partitionBy(*keys).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_table(df: DataFrame, table: str) -> None:
    """Add rows to a table, whatever it holds: done twice, they are there twice."""
    df.write.mode("append").saveAsTable(table)


def export_csv(df: DataFrame, path: str) -> None:
    """Gzip CSV files with a header, one per partition."""
    df.write.mode("overwrite").option("compression", "gzip").csv(path, header=True)


def read_csv_folder(
    spark: SparkSession, path: str, schema: StructType | str, extension: str | None = None
) -> DataFrame:
    """All CSV files of a folder; with an extension only the files that end in it."""
    return _csv_reader(spark, schema, extension).csv(path)


def _csv_reader(spark: SparkSession, schema: StructType | str, extension: str | None):
    reader = spark.read.schema(schema).option("header", True)
    return reader.option("pathGlobFilter", f"*{extension}") if extension else reader


MALFORMED = "_malformed"


def read_csv_checked(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    quarantine: str,
    extension: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The well-formed rows of a folder of CSV files, and the others kept apart.

    A line with too few or too many fields, or with a field that is no value of its type, goes
    to the quarantine table as ``line`` with the ``file`` it stands in; it is not read as nulls.
    The files are parsed once, into a written table.
    """
    fields = schema if isinstance(schema, StructType) else _struct(schema)
    marked = StructType([*fields.fields, StructField(MALFORMED, StringType())])
    reader = _csv_reader(spark, marked, extension).option("mode", "PERMISSIVE")
    rows = reader.option("columnNameOfCorruptRecord", MALFORMED).csv(path)
    parsed = materialise(rows.withColumn("_file", F.col("_metadata.file_path")), "csv")
    broken = parsed.filter(F.col(MALFORMED).isNotNull())
    kept_apart = publish_parquet(
        broken.select(F.col("_file").alias("file"), F.col(MALFORMED).alias("line")), quarantine
    )
    good = parsed.filter(F.col(MALFORMED).isNull())
    return good.select(*fields.names), kept_apart


def _struct(schema: str) -> StructType:
    return StructType.fromDDL(schema)


def save_model(model: MLWritable, base: str, day: date | None = None) -> str:
    """Save under the day's version; earlier versions stay as they are."""
    stamp = (day or date.today()).strftime("%Y%m%d")
    path = f"{base}/{VERSION_PREFIX}{stamp}"
    model.write().overwrite().save(path)
    return path


COMPLETE = "complete"


def version_path(base: str, stamp: str) -> str:
    """Folder of the version of a moment such as 2020-01-03 06:00:00."""
    return f"{base}/{VERSION_PREFIX}{re.sub(r'[^0-9]', '', stamp)}"


def mark_complete(spark: SparkSession, version: str) -> None:
    """Written last: a version without the mark was not finished and is never loaded."""
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{version}/{COMPLETE}")


def latest_version(spark: SparkSession, base: str, part: str = "") -> str:
    """Path of the newest saved version (that has ``part``), by Spark's file listing."""
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load(f"{base}/{VERSION_PREFIX}*/{part}".rstrip("/"))
            .select(F.regexp_extract("_metadata.file_path", rf"{VERSION_PREFIX}(\d+)/", 1).alias("v"))
        )
        newest = files.agg(F.max("v")).first()[0]
    except AnalysisException as error:
        raise FileNotFoundError(f"no saved version under {base}") from error
    if not newest:
        raise FileNotFoundError(f"no saved version under {base}")
    return f"{base}/{VERSION_PREFIX}{newest}"


def load_model(spark: SparkSession, reader: MLReader, base: str):
    return reader.load(latest_version(spark, base))
