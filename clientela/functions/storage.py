"""Tables written to the folder the cluster shares, to cut lineage and fix sizes."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


#: A session's own setting for runs whose cluster names no checkpoint folder, such as tests.
FOLDER_SETTING = "clientela.shared.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir or, where that is unset, in clientela.shared.dir."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(FOLDER_SETTING, None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return folder.rstrip("/")


def has_folder(spark: SparkSession) -> bool:
    return bool(
        spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(FOLDER_SETTING, None)
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/clientela/{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write the rows once and go on from the written table.

    Later steps survive lost executors without recomputing what led here, read
    only the columns they use, and see the true size of the table: Spark then
    broadcasts it only when it is below spark.sql.autoBroadcastJoinThreshold.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_bytes(table: DataFrame) -> int:
    """The size of a written table's files."""
    files = table.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(F.sum("file_size")).first()[0] or 0


def broadcast_bytes(spark: SparkSession) -> int:
    """The session's threshold, up to which Spark broadcasts a table; -1 where it never does."""
    setting = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)([bkmgtp]?)b?", setting).groups()
    return int(number) * 1024 ** "bkmgtp".index(unit or "b")


def session_tasks(spark: SparkSession) -> int:
    """The tasks that a large shuffle of the session has at least.

    Adaptive execution merges shuffle partitions until a task for each core is left, or, where
    the session prefers large partitions to busy cores, without such a bound.
    """
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    adaptive = "spark.sql.adaptive"
    merging = f"{adaptive}.coalescePartitions"
    if any(spark.conf.get(f"{name}.enabled").lower() != "true" for name in (adaptive, merging)):
        return partitions
    least = spark.conf.get(f"{merging}.minPartitionNum", None)
    if least is None:
        busy = spark.conf.get(f"{merging}.parallelismFirst").lower() == "true"
        least = spark.sparkContext.defaultParallelism if busy else 1
    return min(partitions, int(least))


def tasks_of(spark: SparkSession, rows: int, per_task: int) -> int | None:
    """The tasks that hold ``rows`` rows, or None where the session's own shuffles do."""
    wanted = -(-rows // per_task)
    return wanted if wanted > session_tasks(spark) else None


def spread(df: DataFrame, tasks: int | None, *keys: str | Column) -> DataFrame:
    """Rows dealt by keys to a number of tasks, or as the session deals them."""
    return df.repartition(*keys) if tasks is None else df.repartition(tasks, *keys)
