"""Intermediate tables in the folder that the driver and all executors share.

Writing a table and reading it again cuts its lineage, so that a lost executor costs a
re-read and not a recomputation.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; one of our own only where none is set and all runs in one process, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: executors and the driver need a folder that they share")
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/sievecraft-{spark.sparkContext.applicationId}"


def save(df: DataFrame, name: str, by: tuple[str, ...] = (), compression: str = "snappy") -> DataFrame:
    """Write df to the shared folder, in a folder for each value of the columns ``by``, and read it again."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path, partitionBy=list(by), compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(spark: SparkSession) -> int:
    """Tasks that heavy rows are dealt out to: some for each core, however few bytes the rows are."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def spread(df: DataFrame) -> DataFrame:
    """df dealt out evenly to some tasks for each core: a file of one row group is read by one task, however much work its rows are."""
    return df.repartition(dealt(df.sparkSession))
