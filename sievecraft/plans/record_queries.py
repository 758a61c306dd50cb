"""Queries of validity, deduplication, joins, merges, queues and roll-ups."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions.pairs import bag_dice
from ..operators import fuse, queues, records, rollup
from ..sources.tables import alias_images, public_rows
from .adapters import LETTERS, posts
from .catalogue import query, table

_NOISE = "|".join(re.escape(x).replace("'", "''") for x in records.NOISE)
_PATTERNS = "|".join(f"(?:{p})" for p in records.NOISE_PATTERNS).replace("'", "''")
_ASCII = r"""^[A-Za-z0-9\s.,!?'"\-:#@]+$""".replace("'", "''")
_CLASSIFIED = rf"""
  select doc_id, author, caption, has_image,
    case when t = '' and not has_image then 'missing_label_and_image'
         when t = '' then 'missing_label'
         when noise then 'ui_noise_caption'
         when not (regexp_matches(t, '{records.CONTENT}')
                or (length(t) >= 20 and regexp_matches(t, '(?i){records.DIACRITICS}'))
                or (length(t) >= 16 and len(regexp_extract_all(t, '[A-Za-z]{{4,}}')) >= 2)
                or (length(t) >= 20 and regexp_matches(t, '{_ASCII}'))) then 'not_content_caption'
         when not has_image then 'missing_image' end as reason
  from (select *, n = '' or regexp_matches(n, '^(?:{_NOISE})(?: |$)') or (length(n) <= 64 and regexp_matches(n, '(?:{_NOISE})')) or regexp_matches(n, '(?i){_PATTERNS}') as noise
        from (select doc_id, source as author, text as caption, doc_id % 7 <> 0 as has_image,
                     regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g') as t,
                     regexp_replace(lower(regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g')), '\s+', ' ', 'g') as n
              from documents))
"""


@query(f"select author, reason is null as valid, reason, count(*) as n from ({_CLASSIFIED}) c where doc_id not in (select doc_id from labels) group by all")
def slice0_validity_rollup(spark, sf_dir):
    """New posts (those without a label), classified, by author and reason."""
    fresh = posts(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left_anti")
    c = fresh.withColumn("c", records.classify(F.col("caption"), F.col("image_urls")))
    return c.groupBy("author", F.col("c.valid").alias("valid"), F.col("c.reason").alias("reason")).agg(F.count("*").alias("n"))


@query(f"select doc_id, reason from ({_CLASSIFIED}) c where reason is not null")
def p2_invalid_posts(spark, sf_dir):
    return posts(spark, sf_dir).select("doc_id", records.classify(F.col("caption"), F.col("image_urls"))["reason"].alias("reason")).where("reason is not null")


@query(f"select doc_id, caption as label, reason is null as is_valid, case reason when 'missing_label' then 'missing_caption' when 'missing_label_and_image' then 'missing_caption_and_image' else reason end as invalid_reason from ({_CLASSIFIED}) c")
def p5_deliverable_rows(spark, sf_dir):
    rows = posts(spark, sf_dir).withColumn("c", records.classify(F.col("caption"), F.col("image_urls")))
    rows = rows.withColumn("valid", F.col("c.valid")).withColumn("invalid_reason", records.discover_reason(F.col("c.reason")))
    return records.deliverable(rows).select(F.col("post_id").cast("long").alias("doc_id"), "label", "is_valid", "invalid_reason")


@query("select doc_id, case when doc_id % 3 = 0 then 1 when doc_id % 3 = 1 then 2 else 0 end as n_images from documents")
def p1_alias_images(spark, sf_dir):
    one = F.concat(F.lit("https://x/"), F.col("doc_id").cast("string"))
    d = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, one).otherwise("").alias("images"), F.when(F.col("doc_id") % 3 == 1, F.to_json(F.array(one, F.lit("https://y")))).alias("image_urls"))
    return d.select("doc_id", F.size(alias_images(F.col("images"), F.col("image_urls"))).alias("n_images"))


@query("select page_id, regexp_matches(url, '^https?://') and regexp_matches(url, 'm\\.|example') and not regexp_matches(url, 'icon|avatar|emoji|profile') as usable from pages")
def p6_usable_urls(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", records.usable_image(F.col("url"), r"m\.|example").alias("usable"))


@query("select page_id, case when page_id % 2 = 0 then url else 'https://x/groups/1/posts/' || page_id end as best from pages")
def p7_best_url(spark, sf_dir):
    post = F.concat(F.lit("https://x/groups/1/posts/"), F.col("page_id").cast("string"))
    other = F.when(F.col("page_id") % 2 == 0, "https://x/login?next=1").otherwise(post)
    return table(spark, sf_dir, "pages").select("page_id", records.best_url(F.array(F.lit(""), other, F.col("url"))).alias("best"))


@query("select doc_id, doc_id % 4 as attempts from documents where doc_id % 4 < 3 and doc_id % 5 <> 0 and doc_id % 6 in (0, 1) order by doc_id % 4, cast(doc_id as varchar) limit 200")
def p8_recheck_candidates(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    reason = F.when(F.col("doc_id") % 6 == 0, "missing_image").when(F.col("doc_id") % 6 == 1, " Missing_Date").otherwise("ui_noise_caption")
    rows = d.select(F.col("doc_id").cast("string").alias("post_id"), "doc_id", (F.col("doc_id") % 4).alias("recheck_attempts"), (F.col("doc_id") % 5 == 0).alias("recheck_exhausted"), reason.alias("invalid_reason"))
    return records.recheck_candidates(rows, 200, 3).select("doc_id", F.col("recheck_attempts").alias("attempts"))


@query("select event_id from (select event_id, coalesce(max(cast(value <= 3 as int)) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding), 0) as cut from events) where cut = 0")
def p14_cut_at_bottom(spark, sf_dir):
    return queues.cut_at_year(table(spark, sf_dir, "events"), "user_id", "event_id", F.col("value"), 3).select("event_id")


@query("select d.user_id, min(event_id) as event_id from events d where d.user_id not in (select doc_id from labels where toxic = 1) group by d.user_id")
def j1_new_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id")
    seen = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("user_id"))
    return records.new_rows(events, seen, "user_id", "event_id")


@query("select doc_id from documents where doc_id not in (select doc_id from labels union select page_id from pages where page_id % 2 = 0)")
def j2_unseen_by_several(spark, sf_dir):
    seen = records.union_seen("doc_id", table(spark, sf_dir, "labels"), table(spark, sf_dir, "pages").where("page_id % 2 = 0").select(F.col("page_id").alias("doc_id")))
    return table(spark, sf_dir, "documents").select("doc_id").join(seen, "doc_id", "left_anti")


@query("select o_orderkey, coalesce(case when o_custkey % 3 = 0 then c_name end, 'k' || o_custkey) as caption from orders left join customer on o_custkey = c_custkey")
def j3_caption_lookup(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("key"))
    low = o.select("key", F.concat(F.lit("k"), F.col("key").cast("string")).alias("caption")).distinct()
    high = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise(" ").alias("caption"))
    return records.lookup_by_priority(o, "key", "caption", low, high).select("o_orderkey", "caption")


@query("select coalesce(f.doc_id, l.doc_id, d.doc_id) as doc_id, case when f.doc_id is not null then 'fuse' when l.doc_id is not null then 'legacy_ocr' else 'pending' end as gt_source, f.doc_id is not null and l.doc_id is not null as both_present from documents d left join (select distinct doc_id from documents where doc_id % 2 = 0 and trim(text) <> '') f using (doc_id) left join (select distinct doc_id from documents where doc_id % 3 = 0 and trim(text) <> '') l using (doc_id)")
def j6_merge_sources(spark, sf_dir):
    return _merged(spark, sf_dir).select("doc_id", "gt_source", "both_present")


def _merged(spark, sf_dir):
    """Documents with two label sources, each a part of the texts, and the bag of letters of both."""
    d = table(spark, sf_dir, "documents")
    texts = d.select("doc_id", F.col("text").alias("ground_truth"))
    return records.merge_sources(d.select("doc_id"), texts.where("doc_id % 2 = 0"), texts.where("doc_id % 3 = 0"), "doc_id", bag_dice(F.col("fuse_gt"), F.col("legacy_gt"), LETTERS))


@query("select p_partkey, l.k is null as lacks_label, j.k is null as lacks_judge from part left join (select distinct l_partkey as k from lineitem where l_quantity > 40) l on l.k = p_partkey left join (select distinct l_partkey as k from lineitem where l_discount > 0.08) j on j.k = p_partkey where l.k is null or j.k is null")
def j7_gaps(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").withColumn("p_partkey", F.col("l_partkey"))
    return records.gaps(table(spark, sf_dir, "part"), line.where("l_quantity > 40"), line.where("l_discount > 0.08"), "p_partkey")


@query("select (select count(distinct doc_id) from documents where doc_id not in (select doc_id from labels)) as added, (select count(distinct doc_id) from labels where doc_id not in (select doc_id from documents)) as removed")
def j12_set_difference(spark, sf_dir):
    return records.set_difference_counts(table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"), "doc_id")


@query("with last as (select user_id, max_by(event_type, event_id) as event_type from events where event_id % 2 = 1 group by user_id), old as (select user_id, max_by(event_type, event_id) as event_type from events where event_id % 2 = 0 group by user_id) select user_id, event_type from last union all select user_id, event_type from old where user_id not in (select user_id from last)")
def u1_upsert(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("image"), "event_type", "event_id")
    old = e.where("event_id % 2 = 0").groupBy("image").agg(F.max_by("event_type", "event_id").alias("event_type"), F.max("event_id").alias("event_id"))
    return records.upsert(old, e.where("event_id % 2 = 1"), "image", "event_id").select(F.col("image").cast("long").alias("user_id"), "event_type")


@query("select user_id, max_by(event_id, {'ts': date_trunc('hour', ts), 'e': event_id}) as event_id from events group by user_id")
def u2_newest(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", F.date_trunc("hour", "ts").alias("at"), "event_id")
    return records.newest("user_id", "at", e.groupBy("user_id", "at").agg(F.max("event_id").alias("event_id"))).select("user_id", "event_id")


@query("select user_id, max_by(nullif(event_type, 'view'), event_id) filter (where event_type <> 'view') as event_type, list_sort(list_distinct(list(event_type)))::varchar as kinds, bool_or(value > 40) as is_valid, min(event_id) as first_seen_at from events group by user_id")
def u4_merge_fields(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type")).alias("event_type"), F.array("event_type").alias("kinds"), (F.col("value") > 40).alias("is_valid"), F.col("event_id").alias("first_seen_at"))
    m = records.merge_fields(e, "user_id", "event_id", ["event_type"], ["kinds"])
    kinds = F.concat(F.lit("["), F.array_join(F.array_sort("kinds"), ", "), F.lit("]")).alias("kinds")
    return m.select("user_id", "event_type", kinds, "is_valid", "first_seen_at")


@query("select page_id, split_part(url, '?', 1) as base, 1 as n from pages")
def u6_distinct_images(spark, sf_dir):
    base = F.split_part(F.col("url"), F.lit("?"), F.lit(1))
    kept = records.distinct_images(F.array(F.col("url"), F.concat(base, F.lit("?b=2")), F.lit(""), F.concat(base, F.lit("/v.mp4"))))
    return table(spark, sf_dir, "pages").select("page_id", F.split_part(F.get(kept, F.lit(0)), F.lit("?"), F.lit(1)).alias("base"), F.size(kept).alias("n"))


@query("select o_orderkey, case when o_orderkey % 4 = 0 then coalesce(c_name, '') else 'own' end as label, o_orderkey % 4 = 0 and c_name is not null as label_backfill from orders left join customer on o_custkey = c_custkey")
def u9_backfill(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("k"), F.when(F.col("o_orderkey") % 4 == 0, "").otherwise("own").alias("label"))
    known = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("label"))
    return records.backfill(o, known, "k", "label").select("o_orderkey", "label", "label_backfill")


@query("select doc_id, coalesce(text, '') as ground_truth, '' as side_matter, coalesce(source, '') as label from documents")
def s10_public_rows(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    rows = d.select(F.col("doc_id").cast("string").alias("image"), F.col("source").alias("label"), F.col("text").alias("ground_truth"), F.lit(None).cast("string").alias("side_matter"), F.array().cast("array<string>").alias("boxes"), F.lit("").alias("post_link"))
    return public_rows(rows).select(F.col("image").cast("long").alias("doc_id"), "ground_truth", "side_matter", "label")


@query("select batch, count(*) as n, min(o_orderkey) as first from (select o_orderkey, cast(case when i < (12 - r) * b then i // b else (12 - r) + (i - (12 - r) * b) // (b + 1) end as int) as batch from (select o_orderkey, row_number() over (order by o_orderkey) - 1 as i, count(*) over () // 12 as b, count(*) over () % 12 as r from orders)) group by batch")
def w4_contiguous_split(spark, sf_dir):
    return queues.contiguous_split(table(spark, sf_dir, "orders").select("o_orderkey"), 12, "o_orderkey").groupBy("batch").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first"))


@query("select cast(900 - (row_number() over (order by o_orderkey) - 1) % 8 as int) as seq, o_orderkey from orders")
def w5_round_robin_shards(spark, sf_dir):
    return queues.round_robin_shards(table(spark, sf_dir, "orders").select("o_orderkey"), 8, 900, "o_orderkey")


@query("select seq, image from (select o_orderkey % 12 as seq, cast(o_orderkey as varchar) as image, row_number() over (partition by o_orderkey % 12 order by o_orderkey) as turn from orders where o_orderkey not in (select l_orderkey from lineitem where l_quantity < 5)) order by turn, seq limit 500")
def w6_select_round_robin(spark, sf_dir):
    q = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 12).alias("seq"), F.col("o_orderkey").cast("string").alias("image"), "o_orderkey")
    done = table(spark, sf_dir, "lineitem").where("l_quantity < 5").select(F.col("l_orderkey").cast("string").alias("image"))
    return queues.select_round_robin(q, done, "seq", "image", 500, "o_orderkey").select("seq", "image")


@query("select user_id, max(streak) as longest from (select user_id, sum(cast(seen as int)) over (partition by user_id, block order by event_id) as streak from (select *, sum(cast(not seen as int)) over (partition by user_id order by event_id) as block from (select user_id, event_id, value > 5 as seen from events))) group by user_id")
def w8_skip_streaks(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    return queues.skip_streaks(e, "user_id", "event_id", F.col("value") > 5).groupBy("user_id").agg(F.max("streak").alias("longest"))


@query("select user_id, event_id, row_number() over (partition by user_id order by event_id) as round from events")
def w11_versions(spark, sf_dir):
    return queues.versioned(table(spark, sf_dir, "events").select("user_id", "event_id"), "user_id", "event_id")


@query("select count(*) as total, count(*) filter (value < 1) as bad, count(*) filter (value >= 1 and user_id % 3 = 0) as skipped_seen, count(*) filter (value >= 1 and user_id % 3 <> 0) as selected, count(*) filter (value >= 1 and user_id % 3 <> 0 and event_type <> 'error') as live, count(*) filter (value >= 1 and user_id % 3 <> 0 and event_type = 'error') as expired from events")
def a1_ingest_stats(spark, sf_dir):
    return rollup.ingest_stats(table(spark, sf_dir, "events"), F.col("value") < 1, F.col("user_id") % 3 == 0, F.col("event_type") != "error")


@query("select day, n_valid, n_invalid, cast(sum(n_valid) over (order by day) as bigint) as all_valid, cast(sum(n_invalid) over (order by day) as bigint) as all_invalid from (select day(ts) as day, count(*) filter (event_type <> 'error') as n_valid, count(*) filter (event_type = 'error') as n_invalid from events group by day(ts))")
def a2_batch_stats(spark, sf_dir):
    return rollup.batch_stats(table(spark, sf_dir, "events").withColumn("day", F.dayofmonth("ts")), "day", F.col("event_type") != "error")


@query("select count(*) as n, count(*) filter (event_type = 'error') as n_error, count(*) filter (value > 20) as n_large, round_even(avg(value) filter (value > 0), 4)::double as mean_value, cast(trunc(quantile_cont(v, 0.5)) as int) as p50_latency_ms, cast(list_sort(list(v))[1 + cast(floor(0.95 * (count(v) - 1)) as bigint)] as int) as p95_latency_ms from (select *, nullif(cast(floor(value) as int), 0) as v from events)")
def a3_judge_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("flags", F.array("event_type")).withColumn("ms", F.floor("value").cast("int"))
    return rollup.judge_summary(rows, "flags", {"n_error": "error"}, {"n_large": F.col("value") > 20}, {"mean_value": "value"}, "ms")


@query("select 'event_type' as name, event_type as value, count(*) as n from events group by event_type union all select 'user_id', cast(user_id as varchar), count(*) from events group by user_id")
def a4_histograms(spark, sf_dir):
    return rollup.histograms(table(spark, sf_dir, "events"), "event_type", "user_id")


@query("select l_orderkey, string_agg(l_returnflag || '=' || n, '; ' order by l_returnflag) as line_status from (select l_orderkey, l_returnflag, count(*) as n from lineitem group by all) group by l_orderkey")
def a5_status_counts(spark, sf_dir):
    return rollup.status_counts(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_returnflag")


@query("select gt_source, count(*) as n, 0::bigint as n_diverge from (select case when doc_id % 2 = 0 and trim(text) <> '' then 'fuse' when doc_id % 3 = 0 and trim(text) <> '' then 'legacy_ocr' else 'pending' end as gt_source from documents) group by gt_source")
def a6_merge_summary(spark, sf_dir):
    return rollup.merge_summary(_merged(spark, sf_dir))


@query("select count(distinct o_orderkey) as n_queue, count(distinct o_orderkey) filter (d.k is not null) as n_done, count(distinct o_orderkey) filter (d.k is null) as n_pending, count(distinct o_orderkey) filter (d.k is null) > 100 as more_pending from orders left join (select distinct l_orderkey as k from lineitem) d on k = o_orderkey")
def a8_run_summary(spark, sf_dir):
    return rollup.run_summary(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", 100)


@query("select user_id, cast(count(distinct event_type) as int) as n_images, arg_max(event_type, length(event_type) * 1000 + ascii(event_type)) as caption from events group by user_id")
def a9_images_per_post(spark, sf_dir):
    g = rollup.images_per_post(table(spark, sf_dir, "events"), "user_id", "event_type", "event_type")
    return g.select("user_id", F.size("images").alias("n_images"), "caption")


@query("select source as post, count(*) filter (quality = 1 and toxic = 0) as kept from documents join labels using (doc_id) group by source")
def f12_gate_posts(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    rows = d.select(F.col("source").alias("post"), F.col("doc_id").alias("pos"), F.col("doc_id").cast("string").alias("url"), F.when(F.col("quality") == 1, "brush").otherwise("print").alias("kind"), F.when(F.col("toxic") == 1, "spam").otherwise("calligraphy").alias("media"), F.lit(0.9).alias("conf"))
    keep = fuse.keep_image(F.lit(True), F.col("kind"), F.col("media"), F.col("conf"))
    return fuse.gate_posts(rows, "post", "url", keep, "conf").select("post", F.col("kept_image_count").cast("long").alias("kept"))


@query("select event_id, round_even(0.35 * (event_type <> 'error')::int + 0.2 * (case event_type when 'click' then 1 when 'view' then 0.5 else 0.2 end) + 0.2 * greatest(0, least(1, round_even(value / 50, 4))) + 0.15 * (value >= 2)::int + 0.1 * (user_id % 2)::int, 4)::double as score from events")
def f14_vote_score(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    source = F.when(F.col("event_type") == "click", "model").when(F.col("event_type") == "view", "retry").otherwise("fallback_a")
    return e.select("event_id", fuse.vote_score(F.col("event_type") != "error", source, F.col("value") / 50, F.col("value") < 2, F.col("user_id") % 2 == 0).alias("score"))


@query("select event_id, case when event_type = 'error' then 're_ocr' when event_type = 'click' and value / 50 <= 0.5 then 'hitl' when event_type = 'view' then 'refine' end as queue from events")
def f18_route(spark, sf_dir):
    code = F.when(F.col("event_type") == "error", "blur").when(F.col("event_type") == "click", "semantic_break").when(F.col("event_type") == "view", "punct").otherwise("none")
    e = table(spark, sf_dir, "events")
    return e.select("event_id", fuse.route(fuse.eval_status(F.array(code), F.col("value") / 50, ("blur",), ("punct",))).alias("queue"))


@query("select doc_id from documents where doc_id not in (select doc_id from labels)")
def x2_difference(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").subtract(table(spark, sf_dir, "labels").select("doc_id"))


_FUSED = "regexp_replace(text, '[^A-Za-z]', '', 'g')"
_LEGACY = f"case when doc_id % 3 = 0 then regexp_replace({_FUSED}, '[aeinorstAEINORST]', '', 'g') else {_FUSED} end"
_COMMON = "list_sum([least(length(a) - length(replace(a, c, '')), length(b) - length(replace(b, c, ''))) for c in list_distinct(string_split(a, ''))])"
_BAGS = f"""
  select doc_id, case when length(a) + length(b) = 0 then 1 else round_even(2.0::double * coalesce({_COMMON}, 0) / (length(a) + length(b)), 4) end::double as bag
  from (select doc_id, max({_FUSED}) as a, max({_LEGACY}) as b from documents where regexp_matches(text, '\\S') and regexp_matches(case when doc_id % 3 = 0 then regexp_replace(text, '[aeinorstAEINORST]', '', 'g') else text end, '\\S') group by doc_id)
"""


@query(f"select d.doc_id, b.bag as bag_fuse_vs_legacy, coalesce(b.bag < 0.7, false) as diverge_flag from documents d left join ({_BAGS}) b using (doc_id)")
def j6_merged_bag(spark, sf_dir):
    """The merge's score and flag; the legacy source lacks common letters in each third text."""
    return _slipped(spark, sf_dir).select("doc_id", "bag_fuse_vs_legacy", "diverge_flag")


@query(f"select case when regexp_matches(coalesce(text, ''), '\\S') then 'fuse' else 'pending' end as gt_source, count(*) as n, count(*) filter (b.bag < 0.7) as n_diverge from documents d left join ({_BAGS}) b using (doc_id) group by 1")
def a6_merged_bag_summary(spark, sf_dir):
    return rollup.merge_summary(_slipped(spark, sf_dir))


def _slipped(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    fused = d.select("doc_id", F.col("text").alias("ground_truth"))
    slip = F.when(F.col("doc_id") % 3 == 0, F.regexp_replace("text", "[aeinorstAEINORST]", "")).otherwise(F.col("text"))
    return records.merge_sources(d.select("doc_id"), fused, d.select("doc_id", slip.alias("ground_truth")), "doc_id", bag_dice(F.col("fuse_gt"), F.col("legacy_gt"), LETTERS))
