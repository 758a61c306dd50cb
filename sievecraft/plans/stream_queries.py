"""Incremental queries: the same result as their batch form, over a stream of the table's files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..sources.scratch import shared_dir
from ..streaming import feed
from .catalogue import query, table


def _folder(spark) -> str:
    """A folder of our own that the cluster shares."""
    return f"{shared_dir(spark)}/feed-{uuid.uuid4().hex[:12]}"


def _stream(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    folder = _folder(spark)
    rows.write.parquet(f"{folder}/in")
    return feed.read_feed(spark, f"{folder}/in", rows.schema), folder


@query("select user_id, count(*) as n from (select distinct user_id, event_id from events) group by user_id")
def st1_incremental_counts(spark, sf_dir):
    """Batches appended to a table as they come, each in a folder of its own number, then counted."""
    stream, folder = _stream(spark, sf_dir)

    def work(batch, number):
        batch.select("user_id", "event_id").write.mode("overwrite").parquet(f"{folder}/out/v={number}")

    feed.run_batches(stream, work, f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema("user_id long, event_id long").parquet(f"{folder}/out").groupBy("user_id").agg(F.count("*").alias("n"))


_SEEN = "select user_id, event_id, event_id > min(event_id) over (partition by user_id, event_type) as seen from events"
_RUNS = f"select *, sum((not seen)::int) over (partition by user_id order by event_id) as block from ({_SEEN})"
_STREAKS = f"select *, sum(seen::int) over (partition by user_id, block order by event_id) as streak from ({_RUNS})"
_SWITCH = f"select user_id, min(event_id) as at from ({_STREAKS}) where streak = 5 group by user_id"
_MODES = f"""
  select user_id, count(*) filter (not seen) as taken, count(*) filter (seen) as skipped, case when min(s.at) is null then 'catchup' else 'backfill' end as mode,
         count(*) filter (seen and block = last and event_id > coalesce(s.at, -1)) as run
  from (select *, max(block) over (partition by user_id) as last from ({_STREAKS})) left join ({_SWITCH}) s using (user_id) group by user_id
"""


@query(_MODES)
def st2_crawl_modes(spark, sf_dir):
    """A stateful run over the table in two halves, the second resumed from the first's checkpoint: what each group took, skipped, and ends in."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    half = rows.agg(F.expr("(min(event_id) + max(event_id)) div 2").alias("h")).first()["h"] or 0
    folder = _folder(spark)

    def work(batch, number):
        batch.withColumn("number", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/out/v={number}")

    for part in (rows.where(F.col("event_id") <= half), rows.where(F.col("event_id") > half)):
        part.write.mode("append").parquet(f"{folder}/in")
        modes = feed.crawl_modes(feed.read_feed(spark, f"{folder}/in", rows.schema, 1_000_000), "user_id", "event_type", "event_id", 5)
        feed.run_batches(modes, work, f"{folder}/checkpoint").awaitTermination()
    out = spark.read.schema("group string, taken long, skipped long, run long, mode string, switched int, number int").parquet(f"{folder}/out")
    last = lambda c: F.max_by(c, "number").alias(c)
    return out.groupBy(F.col("group").cast("long").alias("user_id")).agg(F.sum("taken").alias("taken"), F.sum("skipped").alias("skipped"), last("mode"), last("run"))


@query("select user_id as key, count(*) as n from events group by user_id")
def st4_upsert_sink(spark, sf_dir):
    """Running counts by key, upserted batch by batch."""
    stream, folder = _stream(spark, sf_dir)

    def add(old, batch):
        per = batch.groupBy("key").agg(F.count("*").alias("n"))
        return old.unionByName(per).groupBy("key").agg(F.sum("n").alias("n"))

    keyed = stream.select(F.col("user_id").cast("string").alias("key"), "event_id")
    feed.run_batches(keyed, feed.upsert_batches(f"{folder}/out", "key", "event_id", "key string, n long", merge=add), f"{folder}/checkpoint").awaitTermination()
    return feed.read_upserted(spark, f"{folder}/out", "key string, n long").select(F.col("key").cast("long").alias("key"), "n")


@query("select coalesce(q.k, a.k) as key, coalesce(a.n, 0) + (q.k is not null)::int as attempts, s.k is null and coalesce(a.n, 0) + (q.k is not null)::int >= 3 as exhausted from (select distinct doc_id as k from documents where doc_id % 2 = 0) q full join (select doc_id as k, cast(doc_id % 4 as int) as n from labels) a on a.k = q.k left join (select doc_id as k from labels where quality = 1) s on s.k = coalesce(q.k, a.k)")
def st6_retry_ladder(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    queue = table(spark, sf_dir, "documents").where("doc_id % 2 = 0").select(F.col("doc_id").alias("key"))
    attempts = labels.select(F.col("doc_id").alias("key"), (F.col("doc_id") % 4).cast("int").alias("attempts"))
    return feed.retry(queue, attempts, labels.where("quality = 1").select(F.col("doc_id").alias("key")), "key", 3)
