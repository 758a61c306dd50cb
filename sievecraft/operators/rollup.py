"""Run summaries: counts, means, latencies and histograms."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ingest_stats(rows: DataFrame, bad: Column, seen: Column, live: Column) -> DataFrame:
    """One row: total, bad, skipped_seen, selected, live and expired rows of an ingest."""
    ok = ~bad & ~seen
    return rows.agg(F.count("*").alias("total"), F.count_if(bad).alias("bad"), F.count_if(~bad & seen).alias("skipped_seen"), F.count_if(ok).alias("selected"), F.count_if(ok & live).alias("live"), F.count_if(ok & ~live).alias("expired"))


def batch_stats(rows: DataFrame, batch: str, valid: Column) -> DataFrame:
    """Per batch valid and invalid rows, and both summed up over the batches so far.

    The running sum is over batches, which are few, not over rows.
    """
    per = rows.groupBy(batch).agg(F.count_if(valid).alias("n_valid"), F.count_if(~valid).alias("n_invalid"))
    so_far = Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, 0)
    return per.withColumn("all_valid", F.sum("n_valid").over(so_far)).withColumn("all_invalid", F.sum("n_invalid").over(so_far))


def judge_summary(rows: DataFrame, flags: str, counted: Mapping[str, str], buckets: Mapping[str, Column], means: Mapping[str, str], latency: str) -> DataFrame:
    """One row: n, a count for each named flag and bucket, means over values above 0, median and 95th latency.

    The 95th is the value at place int(0.95 * (n - 1)) of the sorted positive ones.
    """
    aggs = [F.count("*").alias("n")]
    aggs += [F.count_if(F.array_contains(flags, flag)).alias(name) for name, flag in counted.items()]
    aggs += [F.count_if(when).alias(name) for name, when in buckets.items()]
    aggs += [F.bround(F.avg(F.when(F.col(c) > 0, F.col(c))), 4).alias(name) for name, c in means.items()]
    positive = F.when(F.col(latency) > 0, F.col(latency))
    aggs += [F.percentile(positive, 0.5).cast("int").alias("p50_latency_ms"), F.count(positive).alias("_n")]
    one = rows.agg(*aggs)
    # Found among the distinct latencies, which are whole milliseconds: rows are not sorted.
    per = rows.where(F.col(latency) > 0).groupBy(latency).agg(F.count("*").alias("c")).withColumn("upto", F.sum("c").over(Window.orderBy(latency)))
    p95 = per.where(F.col("upto") > F.floor((one.select("_n").scalar() - 1) * 0.95)).agg(F.min(latency).cast("int").alias("p95_latency_ms"))
    return one.drop("_n").withColumn("p95_latency_ms", p95.scalar())


def histogram(rows: DataFrame, array: str, name: str = "value") -> DataFrame:
    """How many times each array element occurs over all rows."""
    return rows.select(F.explode(array).alias(name)).groupBy(name).agg(F.count("*").alias("n"))


def histograms(rows: DataFrame, *columns: str) -> DataFrame:
    """(name, value, n) of several columns, in one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns])).alias("p")
    return rows.select(pairs).groupBy("p.name", "p.value").agg(F.count("*").alias("n"))


def status_counts(lines: DataFrame, page: str, status: str) -> DataFrame:
    """Per page its lines' statuses as ``name=count`` in order of name."""
    per = lines.groupBy(page, status).agg(F.count("*").alias("n"))
    text = F.concat_ws("=", F.col(status), F.col("n").cast("string"))
    return per.groupBy(page).agg(F.array_join(F.array_sort(F.collect_list(text)), "; ").alias("line_status"))


def merge_summary(rows: DataFrame) -> DataFrame:
    """Rows and diverging rows by source of the merged label."""
    return rows.groupBy("gt_source").agg(F.count("*").alias("n"), F.count_if("diverge_flag").alias("n_diverge"))


def compare_summary(rows: DataFrame, agree: Column, cer: str) -> DataFrame:
    """One row: rows read and failed, share that agrees, mean error rate of those read."""
    ok = F.col(cer).isNotNull()
    return rows.agg(F.count_if(ok).alias("n_ok"), F.count_if(~ok).alias("n_fail"), F.bround(F.avg(F.when(ok, agree.cast("int"))), 4).alias("agree_rate"), F.bround(F.avg(cer), 4).alias("mean_cer"))


def run_summary(queue: DataFrame, done: DataFrame, key: str, target: int) -> DataFrame:
    """One row: queued, done and pending keys, and whether more than target are pending."""
    d = done.select(key).distinct().withColumn("d", F.lit(1))
    rows = queue.select(key).distinct().join(d, key, "left")
    return rows.agg(F.count("*").alias("n_queue"), F.count("d").alias("n_done"), F.count_if(F.col("d").isNull()).alias("n_pending")).withColumn("more_pending", F.col("n_pending") > target)


def images_per_post(images: DataFrame, post: str, image: str, caption: str) -> DataFrame:
    """Per post its images in order and its longest caption."""
    return images.groupBy(post).agg(F.array_sort(F.collect_set(image)).alias("images"), F.max_by(caption, F.struct(F.length(caption), caption)).alias("caption"))
