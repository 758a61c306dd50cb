"""Append-only logs whose batches count once, however often they are written.

A batch of a run is written to a folder of its own attempt, ``rows/run=../batch=../attempt=..``,
and then named in the log's manifest, ``manifest/<run>-<batch>.json``, whose rename
replaces an earlier attempt's name as a whole. Readers take the attempts that the
manifest names: a batch that failed half-way is not seen, and one that came again after
it was named replaces what it had written. Nothing is read to append.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns of the three logs.
DOWNLOAD_LOG = "post_id string, caption string, ok boolean, reason string, files int, stored array<string>, errors array<string>, batch_seq int, run_id string, at string"
UPSERT_LOG = "post_id string, permalink string, posted_at string, author string, caption string, image_urls array<string>, valid boolean, invalid_reason string, batch_seq int, at string"
JUDGE_LOG = "image string, post_id string, post_link string, raw string, run_id string"
#: Errors of a download that are kept.
ERRORS = 5


def append_log(rows: DataFrame, path: str, run: str, batch: int) -> None:
    """Add a batch of a run to the log below path, or replace what the same batch had added."""
    if not re.fullmatch(r"[\w.-]+", run):
        raise ValueError(f"not a name of a run: {run!r}")
    attempt = uuid.uuid4().hex
    rows.write.parquet(f"{path}/rows/run={run}/batch={batch}/attempt={attempt}")
    spark = rows.sparkSession
    jvm = spark.sparkContext._jvm
    at = lambda name: jvm.org.apache.hadoop.fs.Path(f"{path}/manifest/{name}")
    files = at("x").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = files.create(at(f"_{attempt}"), True)
    out.write(bytearray(json.dumps({"run": run, "batch": batch, "attempt": attempt}).encode()))
    out.close()
    if files.exists(at(f"{run}-{batch}.json")):
        files.delete(at(f"{run}-{batch}.json"), False)
    if not files.rename(at(f"_{attempt}"), at(f"{run}-{batch}.json")):
        raise OSError(f"batch {batch} of run {run} could not be named in {path}/manifest")


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The log's rows with ``run`` and ``batch``; names that begin with an underscore are attempts that were not named."""
    named = spark.read.schema("run string, batch int, attempt string").json(f"{path}/manifest")
    rows = spark.read.schema(f"{schema}, run string, batch int, attempt string").option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    return rows.join(named, ["run", "batch", "attempt"], "left_semi").drop("attempt")


def download_rows(results: DataFrame, run: str, batch: int) -> DataFrame:
    """Rows of the download log from (post_id, caption, urls, stored, errors, at): ok if something was stored without an error."""
    none = F.array().cast("array<string>")
    stored, errors = F.coalesce("stored", none), F.coalesce("errors", none)
    without = F.size(F.coalesce("urls", none)) == 0
    return results.select("post_id", F.coalesce("caption", F.lit("")).alias("caption"), (~without & (F.size(stored) > 0) & (F.size(errors) == 0)).alias("ok"), F.when(without, "no_cdn_urls").alias("reason"), F.when(without, 0).otherwise(F.size(stored)).alias("files"), stored.alias("stored"), F.slice(errors, 1, ERRORS).alias("errors"), F.lit(batch).alias("batch_seq"), F.lit(run).alias("run_id"), "at")
