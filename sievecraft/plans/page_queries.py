"""Queries over page tables, and of the smaller record and queue operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import fuse, pages, queues, records, rollup
from .adapters import tracks
from .catalogue import query, table


@query("select doc_id, length(substr(text, 1, 500)) as n_chars, 12 as n_images from documents where text is not null")
def p15_slim(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text", F.sequence(F.lit(1), F.lit(20)).alias("images"))
    return pages.slim(d, "text", "images").select("doc_id", F.length("text").cast("long").alias("n_chars"), F.size("images").alias("n_images"))


@query("select event_id from events where event_type = 'error' or value < 1")
def p16_refetch(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.where(pages.needs_refetch(F.col("event_type") != "error", F.when(F.col("value") < 1, "missing_image"))).select("event_id")


@query("select p.page_id as k, quality, source from pages p join labels l on l.doc_id = p.page_id left join documents d on d.doc_id = p.page_id and d.doc_id % 2 = 0")
def j5_review_rows(spark, sf_dir):
    judged = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("k"), "quality")
    labels = table(spark, sf_dir, "documents").where("doc_id % 2 = 0").select(F.col("doc_id").alias("k"), "source")
    return pages.review_rows(table(spark, sf_dir, "pages").select(F.col("page_id").alias("k")), judged, labels, "k")


@query("select o_orderkey as k, coalesce(m, o_totalprice) as price from orders left join (select l_orderkey, max(l_extendedprice) as m from lineitem group by l_orderkey) on l_orderkey = o_orderkey")
def j8_attach_results(spark, sf_dir):
    got = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.max("l_extendedprice").alias("price"))
    return pages.attach_results(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price")), got, "k", ("price",))


@query("select distinct l_orderkey as post, l_partkey as tile from lineitem where l_partkey in (select p_partkey from part where p_partkey % 3 = 0)")
def j11_tiles_of_posts(spark, sf_dir):
    posts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("post")).agg(F.collect_set("l_partkey").alias("tiles"))
    tiles = table(spark, sf_dir, "part").where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("tile"))
    return pages.posts_of_tiles(posts, tiles, "post", "tiles", "tile").select("post", "tile")


@query("select event_id, case when event_type = 'click' then 'partial' else '' end as reason from events")
def j13_span_reason(spark, sf_dir):
    spans = F.array(F.struct(F.lit("no").alias("a"), F.lit("x").alias("b"), F.lit("other").alias("reason")), F.struct(F.lit("click").alias("a"), F.lit("x").alias("b"), F.lit("partial").alias("reason")))
    return table(spark, sf_dir, "events").select("event_id", pages.span_reason(spans, F.col("event_type"), F.lit("x")).alias("reason"))


@query("select coalesce(case when s.user_id is not null and (t.user_id is null or s.at >= t.at) then s.event_id end, t.event_id) as event_id, coalesce(s.user_id, t.user_id) as user_id from (select user_id, max(event_id) as event_id, max(event_id // 100) as at from events where event_id % 2 = 0 group by user_id) s full join (select user_id, max(event_id) as event_id, max(event_id // 100) as at from events where event_id % 2 = 1 group by user_id) t using (user_id)")
def u8_rebuild(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("at", F.floor(F.col("event_id") / 100))
    one = lambda odd: e.where(F.col("event_id") % 2 == odd).groupBy("user_id").agg(F.max("event_id").alias("event_id"), F.max("at").alias("at"))
    return pages.rebuild(one(0), one(1), "user_id", "at").select("user_id", "event_id")


@query("select event_id, case when p = 'b' and b <> '' then b when a <> '' then a when b <> '' then b else '' end as text, case when p = 'b' and b <> '' then 'fallback_b' when a <> '' then 'fallback_a' when b <> '' then 'fallback_b' else 'glm_empty_ab' end as source from (select event_id, case when event_id % 3 = 0 then '' else event_type end as a, case when event_id % 4 = 0 then '' else 'other' end as b, case when event_id % 2 = 0 then 'b' else 'a' end as p from events)")
def f15_fallback(spark, sf_dir):
    i = F.col("event_id")
    x = pages.fallback(F.when(i % 3 == 0, "").otherwise(F.col("event_type")), F.when(i % 4 == 0, "").otherwise("other"), F.when(i % 2 == 0, "B").otherwise("a"), "a-z")
    return table(spark, sf_dir, "events").select("event_id", x.alias("x")).select("event_id", "x.text", "x.source")


@query("select event_id, 'glm_agree_fuse,' || case when event_type = 'error' then 'glm_gate_fail' else 'glm_gate_ok' end || case when value > 20 then ',glm_mix' else '' end || case when user_id % 2 = 0 then ',glm_pick_a' else ',glm_pick_b' end as flags from events")
def f16_judge_flags(spark, sf_dir):
    no = F.lit(False)
    flags = pages.judge_flags(F.col("event_type") != "error", no, no, F.lit("model"), F.when(F.col("user_id") % 2 == 0, "A").otherwise("b"), F.lit(True), F.lit("x"), no, F.col("value") > 20)
    return table(spark, sf_dir, "events").select("event_id", F.array_join(flags, ",").alias("flags"))


@query("select event_id, case when event_type = 'error' then 'glm_empty_ab' end as source, case when value / 50 < 0.5 then 'review_weak' when user_id % 2 = 0 then 'review_mix' when value / 50 >= 0.75 then 'review_ok' else 'review_weak' end as bucket from events where event_type <> 'error'")
def f14_review_bucket(spark, sf_dir):
    c, no = F.col("value") / 50, F.lit(False)
    b = fuse.review_bucket(F.lit("model"), no, c, no, F.lit(0), F.lit(True), F.col("user_id") % 2 == 0, F.lit(1), c)
    return table(spark, sf_dir, "events").where("event_type <> 'error'").select("event_id", F.lit(None).cast("string").alias("source"), b.alias("bucket"))


@query("select l_orderkey as post, min(l_partkey || '.jpg') as image from lineitem where l_partkey % 2 = 1 group by l_orderkey order by l_orderkey limit 300")
def w2_first_per_post(spark, sf_dir):
    images = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("post"), F.concat(F.col("l_partkey").cast("string"), F.lit(".jpg")).alias("image"), "l_partkey")
    return queues.first_per_post(images, images.where("l_partkey % 2 = 0"), "post", "image", 300)


@query("select image from (select cast(event_id as varchar) as image, user_id as rtl, cast(floor(value) as int) as ltr from events) order by case when rtl > ltr + 1 then 0 else 1 end, -rtl, image limit 200")
def w3_by_priority(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("image"), F.col("user_id").alias("rtl"), F.floor("value").alias("ltr"))
    return queues.by_priority(e, F.col("rtl"), F.col("ltr"), 200).select("image")


@query("select page_id, 'https://x/cstp=mx1000/' || page_id as first from pages")
def w9_rank_urls(spark, sf_dir):
    p = F.col("page_id").cast("string")
    ranked = queues.rank_urls(F.array(F.col("url"), F.concat(F.lit("https://x/t39.99422/"), p), F.concat(F.lit("https://x/cstp=mx1000/"), p)))
    return table(spark, sf_dir, "pages").select("page_id", F.get(ranked, F.lit(0)).alias("first"))


@query("select doc_id from (select doc_id, case when doc_id % 5 = 0 then 0 else doc_id end as k from documents) order by k desc, doc_id limit 50")
def w10_numeric_order(spark, sf_dir):
    text = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("x"), F.col("doc_id").cast("string"))).otherwise(F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", queues.numeric_key(text).alias("k")).orderBy(F.desc("k"), "doc_id").limit(50).select("doc_id")


@query("select doc_id from labels union select page_id from pages")
def x1_union(spark, sf_dir):
    return records.union_seen("doc_id", table(spark, sf_dir, "labels"), table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id")))


@query("select count(*) filter (value <= 40) as n_ok, count(*) filter (value > 40) as n_fail, round_even(cast(avg((value < 10)::int) filter (value <= 40) as decimal(18, 10)), 4)::double as agree_rate, round_even(cast(avg(round(value / 100, 4)) filter (value <= 40) as decimal(18, 10)), 4)::double as mean_cer from events")
def a7_compare_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("cer", F.when(F.col("value") <= 40, F.round(F.col("value") / 100, 4)))
    return rollup.compare_summary(rows, F.col("value") < 10, "cer")


@query()
def f4_relock(spark, sf_dir):
    """Pages' lines in another order, put back into their own."""
    t = tracks(spark, sf_dir)
    return t.select("image", F.array_join(pages.relock(F.col("a"), F.reverse("a"), "A-Za-z"), "\n").alias("lines"))
