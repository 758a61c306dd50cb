"""Queries of runs: flushes, stops, logs, sidecars, chunks of queues, judged pages, and boxes of two passes."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import judging, layout, pages, queues
from ..sources import logs, tables
from ..sources.scratch import shared_dir, spread
from ..streaming import feed
from .adapters import boxes
from .catalogue import query, table


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_FLUSHES = "select user_id, count(*) as n from events group by user_id"


@query(f"select user_id, cast(unnest(range(1, n // 20 + 1)) as int) as flush, 'rows' as reason, 20 as size from ({_FLUSHES}) where n >= 20")
def st3_flush(spark, sf_dir):
    """Events leave in flushes of 20 a user, over two runs of which the second goes on with what the first left waiting."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id")
    half = rows.agg(F.expr("(min(event_id) + max(event_id)) div 2").alias("h")).first()["h"] or 0
    folder = _folder(spark, "flush")

    def work(batch, number):
        batch.write.mode("overwrite").parquet(f"{folder}/out/v={number}")

    for part in (rows.where(F.col("event_id") <= half), rows.where(F.col("event_id") > half)):
        part.write.mode("append").parquet(f"{folder}/in")
        out = feed.flushed(feed.read_feed(spark, f"{folder}/in", rows.schema, 1_000_000), "user_id", "event_id", seconds=0)
        feed.run_batches(out, work, f"{folder}/checkpoint").awaitTermination()
    got = spark.read.schema("user_id long, event_id long, flush int, reason string, size int").parquet(f"{folder}/out")
    return got.groupBy("user_id", "flush", "reason").agg(F.max("size").alias("size"))


_SLICED = "select *, least(7, (max(event_id) over () - event_id) * 8 // (max(event_id) over () - min(event_id) over () + 1)) as slice from events"
_DECIDED = f"select slice, count(*) filter (event_type <> 'error') as taken, min(event_id) <= (select min(event_id) + (max(event_id) - min(event_id)) * 4 // 10 from events) as bottom from ({_SLICED}) group by slice"


@query(f"select s.batch, 'bottom_year' as reason, (select count(*) from ({_SLICED}) where slice <= s.batch) as n_rows from (select min(slice) as batch from ({_DECIDED}) where bottom) s")
def st5_stop(spark, sf_dir):
    """Events as a feed from the newest to the oldest in eight files; the run stops by itself at the first batch that reaches the bottom."""
    rows = table(spark, sf_dir, "events").select("event_id", "event_type")
    r = rows.agg(F.min("event_id").alias("low"), F.max("event_id").alias("high")).first()
    low, high = r["low"] or 0, r["high"] or 0
    folder = _folder(spark, "stop")
    slice_ = F.least(F.lit(7), F.floor((F.lit(high) - F.col("event_id")) * 8 / (high - low + 1)).cast("int"))
    for k in range(8):
        rows.where(slice_ == k).coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def work(batch, number):
        batch.write.mode("overwrite").parquet(f"{folder}/out/v={number}")

    told = [F.count_if(F.col("event_type") != "error").alias("taken"), F.count_if(F.col("event_type") == "error").alias("failed"), F.min("event_id").alias("oldest_year")]
    end = feed.run_until(feed.read_feed(spark, f"{folder}/in", rows.schema, 1), work, f"{folder}/checkpoint", told, low + (high - low) * 4 // 10, "backfill")
    done = spark.read.schema("event_id long, event_type string").parquet(f"{folder}/out")
    return done.agg(F.lit(end["batch"]).cast("long").alias("batch"), F.lit(end["reason"]).alias("reason"), F.count("*").alias("n_rows"))


@query("select 'r' || event_id % 3 as run, cast(event_id % 4 as int) as batch_seq, count(*) as n, count(*) filter (event_id % 5 > 0 and event_type <> 'error') as n_ok, count(*) filter (event_id % 5 = 0) as n_without from events group by 1, 2")
def s8_append_log(spark, sf_dir):
    """Download results appended batch by batch, every batch twice, as after a failure: each counts once."""
    none = F.array().cast("array<string>")
    i = F.col("event_id")
    results = table(spark, sf_dir, "events").select("event_id", i.cast("string").alias("post_id"), F.col("event_type").alias("caption"), F.when(i % 5 == 0, none).otherwise(F.array(F.lit("u"))).alias("urls"), F.when(i % 5 > 0, F.array(F.lit("k"))).alias("stored"), F.when(F.col("event_type") == "error", F.array(F.lit("broken"))).otherwise(none).alias("errors"), F.lit("").alias("at"))
    path = _folder(spark, "log")
    for run in range(3):
        for batch in range(4):
            part = results.where((i % 3 == run) & (i % 4 == batch))
            for _ in range(2):
                logs.append_log(logs.download_rows(part, f"r{run}", batch).drop("run_id"), path, f"r{run}", batch)
    got = logs.read_log(spark, path, "post_id string, caption string, ok boolean, reason string, files int, stored array<string>, errors array<string>, batch_seq int, at string")
    return got.groupBy("run", "batch_seq").agg(F.count("*").alias("n"), F.count_if("ok").alias("n_ok"), F.count_if(F.col("reason") == "no_cdn_urls").alias("n_without"))


def _sidecars(spark, sf_dir) -> str:
    """A file for each supplier; every seventh is broken, one kind after the other."""
    k = F.col("s_suppkey")
    whole = F.to_json(F.struct(F.concat(F.lit("s"), k.cast("string")).alias("image"), F.col("s_name").alias("text"), F.lit(2).alias("at")))
    broken = F.when(k % 28 == 0, "").when(k % 28 == 7, F.substring(whole, 1, 9)).when(k % 28 == 14, F.concat(F.lit("["), whole, F.lit("]"))).otherwise('{"image": " ", "at": 2}')
    folder = _folder(spark, "sidecars")
    values = spread(table(spark, sf_dir, "supplier").select(F.when(k % 7 == 0, broken).otherwise(whole).alias("value")))
    # Tasks put their files in place themselves; the driver would move them one by one.
    values.write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(folder)
    return folder


_READABLE = "select 's' || s_suppkey as image, s_name as text from supplier where s_suppkey % 7 <> 0"


@query(_READABLE)
def s4_scan_sidecars(spark, sf_dir):
    rows, _ = tables.scan_sidecars(spark, _sidecars(spark, sf_dir), "image string, text string, at int", "image", suffix=".txt")
    return rows.select("image", "text")


@query("select count(*) as files, count(*) filter (s_suppkey % 7 = 0) as unreadable, count(*) filter (s_suppkey % 7 <> 0) as records, count(*) filter (s_suppkey % 2 = 0) as before, count(*) filter (s_suppkey % 2 = 0 or s_suppkey % 7 <> 0) as after, count(*) filter (s_suppkey % 2 = 1 and s_suppkey % 7 <> 0) as recovered from supplier")
def u8_rebuild_counts(spark, sf_dir):
    """A table of half the suppliers rebuilt from all sidecars: how many files were read, lost and recovered."""
    rows, counts = tables.scan_sidecars(spark, _sidecars(spark, sf_dir), "image string, text string, at int", "image", suffix=".txt")
    held = table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("image"), F.lit("old").alias("text"), F.lit(1).alias("at"))
    return pages.rebuild_counted(rows, counts, held, "image", "at")[1]


_BOX = """
  select l_orderkey as page, l_linenumber as line, least(l_linenumber, l_suppkey) as k, ymin, xmin, least(1000, ymin + 20 + l_suppkey % 80) as ymax, least(1000, xmin + 10 + l_partkey % 60) as xmax
  from (select *, least(1000, (l_partkey * 37 + l_suppkey * 11) % 900) as xmin, least(1000, (l_partkey * 53 + l_linenumber * 17) % 900) as ymin from lineitem)
"""


@query(f"""
with b as ({_BOX}),
     p as (select a.page, a.xmin as ax, a.ymin as ay, b.xmin + 3 as bx, b.ymin + 2 as b_y, a.xmax as axx, a.ymax as ayy, b.xmax + 3 as bxx, b.ymax + 2 as byy from b a join b using (page)),
     o as (select *, greatest(0, least(axx, bxx) - greatest(ax, bx)) * greatest(0, least(ayy, byy) - greatest(ay, b_y)) as i from p)
select page, ax, ay, bx, b_y as "by", round(cast(i as double) / ((axx - ax) * (ayy - ay) + (bxx - bx) * (byy - b_y) - i), 6) as iou from o
where i > 0 and cast(i as double) / ((axx - ax) * (ayy - ay) + (bxx - bx) * (byy - b_y) - i) >= 0.25
""")
def j10_overlaps(spark, sf_dir):
    """Boxes of an order's page against those of a second pass, which has all of them a little moved."""
    b = F.col("b")
    first = boxes(spark, sf_dir).select("page", F.lit("a").alias("source"), F.struct(b["ymin"].alias("ymin"), b["xmin"].alias("xmin"), b["ymax"].alias("ymax"), b["xmax"].alias("xmax")).alias("b"))
    second = first.select("page", F.lit("b").alias("source"), F.struct((b["ymin"] + 2).alias("ymin"), (b["xmin"] + 3).alias("xmin"), (b["ymax"] + 2).alias("ymax"), (b["xmax"] + 3).alias("xmax")).alias("b"))
    met = layout.overlaps(first.unionByName(second), "page", "source", "b")
    return met.select("page", F.col("box_a.xmin").alias("ax"), F.col("box_a.ymin").alias("ay"), F.col("box_b.xmin").alias("bx"), F.col("box_b.ymin").alias("by"), F.round("iou", 6).alias("iou"))


_QUEUE = "select o_orderkey % 12 as seq, cast(o_orderkey as varchar) as image, o_orderkey as k, o_orderkey in (select l_orderkey from lineitem where l_quantity < 5) as done from orders"


@query(f"""
with q as ({_QUEUE}),
     p as (select *, row_number() over (partition by seq order by k) as turn from q where not done),
     c as (select * from p order by turn, seq limit 5000),
     n as (select seq, count(*) filter (not done) as n from q group by seq),
     e as (select turn, seq from c order by turn desc, seq desc limit 1),
     l as (select n.seq, max(c.k) as last, any_value(n.n + 1 < e.turn or (n.n + 1 = e.turn and n.seq < e.seq)) as over from n cross join e left join c on c.seq = n.seq group by n.seq)
select (select count(*) from c) as selected,
  (select count(*) from q left join l using (seq) where done and ((select count(*) from p) < 5000 or l.over or q.k < l.last)) as skipped_done,
  cast(5000 as bigint) as target, ((select count(*) from p) >= 5000)::int as chunk_full, (select cast(sum(k) as bigint) from c) as keys
""")
def w6_chunk_of_5000(spark, sf_dir):
    """A chunk beyond the size up to which Spark pushes a limit of ranks down, and what was passed over for it."""
    q = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 12).alias("seq"), F.col("o_orderkey").cast("string").alias("image"), "o_orderkey")
    done = table(spark, sf_dir, "lineitem").where("l_quantity < 5").select(F.col("l_orderkey").cast("string").alias("image"))
    rows, report = queues.select_chunk(q, done, "seq", "image", 5000, "o_orderkey")
    return report.withColumn("keys", rows.agg(F.sum("o_orderkey")).scalar())


@query("""
with w as (select doc_id, regexp_replace(lower(coalesce(text, '')), '[^a-z]', '', 'g') as t from documents),
     x as (select doc_id, t, doc_id % 4 as kind, substr(t, 1, 40) as a from w where length(t) >= 60)
select cast(doc_id as varchar) as image,
  kind <> 1 as gate_ok, case when kind = 1 then 'review_weak' when kind = 2 then 'review_weak' else 'review_ok' end as bucket,
  kind <> 1 and kind <> 3 as agree, case when kind = 1 then 0 else 40 end as n_chars_rec
from x
""")
def f16_judge_log(spark, sf_dir):
    """Log rows of judged texts: accepted as they are, with foreign characters (rejected), of a fallback, and against another fused text."""
    t = F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]", "")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("image"), (F.col("doc_id") % 4).alias("kind"), t.alias("t")).where(F.length("t") >= 60)
    a = F.substring("t", 1, 40)
    none = F.lit(None).cast("array<struct<text:string,kind:string,confidence:double>>")
    rows = docs.select("image", "kind", a.alias("text_a"), a.alias("text_b"), F.when(F.col("kind") == 3, F.concat(a, F.lit("zzz"))).otherwise(a).alias("fuse_gt"), F.when(F.col("kind") == 1, F.repeat(F.lit("q"), 200)).otherwise(a).alias("recommend"), F.lit("a").alias("pick"), F.when(F.col("kind") == 2, "fallback_a").otherwise("model").alias("source"), F.lit(0.9).alias("confidence"), F.lit(False).alias("retried"), (F.col("kind") == 1).alias("dropped"), none.alias("boxes_a"), none.alias("boxes_b"))
    log = judging.judge_log(rows, "a-z", clean=False)
    return log.select("image", "gate_ok", F.col("vote.review_bucket").alias("bucket"), F.col("metrics.agree_with_fuse").alias("agree"), F.col("metrics.n_chars_rec").alias("n_chars_rec"))
