"""Queries of sources and sinks, of record and page predicates, and of the small text and pair functions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import pairs as m
from ..functions import text as t
from ..operators import fuse, layout, pages, queues, records
from ..sources import tables
from ..sources.scratch import shared_dir
from .adapters import LETTERS, boxes
from .catalogue import query, table
from .record_queries import _CLASSIFIED


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@query("select event_id, user_id, event_type, value from events")
def s1_json_lines(spark, sf_dir):
    """Rows written as JSON lines and read back with their schema."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    folder = _folder(spark, "jsonl")
    tables.write_jsonl(rows, folder)
    return tables.read_jsonl(spark, folder, "event_id long, user_id long, event_type string, value double")


@query("select kind, count(*) as n from (select case when event_id % 7 = 0 then 'blank' when event_id % 7 = 1 then 'comment' when event_id % 7 = 2 then 'reject' else 'row' end as kind from events) where kind in ('reject', 'row') group by kind")
def s2_strict_lines(spark, sf_dir):
    """Strict lines: blank ones and comments are skipped, broken ones are rejects."""
    i = F.col("event_id")
    line = F.when(i % 7 == 0, "  ").when(i % 7 == 1, "# note").when(i % 7 == 2, F.concat(F.lit('{"event_id": '), i.cast("string"))).otherwise(F.to_json(F.struct("event_id", "event_type")))
    folder = _folder(spark, "lines")
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(folder)
    rows, rejects = tables.read_jsonl_strict(spark, folder, "event_id long, event_type string")
    return rows.select(F.lit("row").alias("kind")).unionByName(rejects.select(F.lit("reject").alias("kind"))).groupBy("kind").agg(F.count("*").alias("n"))


@query("select 'post' || l_orderkey as post_id, count(distinct l_partkey) as n, min(l_partkey || '.jpg') as first from lineitem where l_linenumber <> 3 group by 1")
def s5_posts_of_paths(spark, sf_dir):
    """Posts from the paths of their images; other files are left out."""
    name = F.concat(F.col("l_partkey").cast("string"), F.when(F.col("l_linenumber") == 3, ".txt").otherwise(".jpg"))
    paths = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("/in/post"), F.col("l_orderkey").cast("string"), F.lit("/"), name).alias("path"))
    return tables.posts_from_paths(paths).select("post_id", F.size("images").cast("long").alias("n"), F.get("images", F.lit(0)).alias("first"))


@query("select event_type <> 'error' as is_valid, count(*) as n, sum(event_id) as ids from events group by 1")
def s9_split_sink(spark, sf_dir):
    """Valid and invalid rows written below one folder each, and read back."""
    folder = _folder(spark, "split")
    rows = table(spark, sf_dir, "events").select("event_id", (F.col("event_type") != "error").alias("is_valid"))
    tables.write_split(rows, folder)
    return spark.read.schema("event_id long, is_valid boolean").parquet(folder).groupBy("is_valid").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("select event_id, count(*) as n from events group by event_id")
def s11_both_prefixes(spark, sf_dir):
    """The same rows below two prefixes: all are there twice in one, once in each."""
    a, b = _folder(spark, "operational"), _folder(spark, "shared")
    tables.write_both(table(spark, sf_dir, "events").select("event_id"), a, b)
    read = lambda p: spark.read.schema("event_id long").parquet(p)
    both = read(a).withColumn("a", F.lit(1)).join(read(b).withColumn("b", F.lit(1)), "event_id", "full")
    return both.groupBy("event_id").agg(F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("n"))


@query(f"select doc_id, coalesce(reason, '') in ('missing_label', 'missing_label_and_image', 'ui_noise_caption') as noise, coalesce(reason, '') not in ('missing_label', 'missing_label_and_image', 'ui_noise_caption', 'not_content_caption') as content from ({_CLASSIFIED}) c")
def p3_noise_and_content(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", records.is_noise(F.col("text")).alias("noise"), records.is_content(F.col("text")).alias("content"))


@query(r"select cast(doc_id as varchar) as post_id, regexp_replace(text, '^\s+|\s+$', '', 'g') as caption, 7 as batch_seq, 1 as n_images, coalesce(source, '') as author from documents where doc_id % 7 <> 0 and doc_id % 3 <> 0 and regexp_matches(coalesce(text, ''), '\S')")
def p9_pass_through(spark, sf_dir):
    """Rows that are complete already: each with two addresses of one image and a video."""
    i, d = F.col("doc_id").cast("string"), table(spark, sf_dir, "documents")
    urls = F.when(F.col("doc_id") % 7 != 0, F.array(F.concat(F.lit("https://x/"), i, F.lit(".jpg?a=1")), F.concat(F.lit("https://x/"), i, F.lit(".jpg?b=2")), F.lit("https://x/v.mp4"))).otherwise(F.array(F.lit("https://x/v.mp4")))
    rows = d.select(i.alias("post_id"), F.lit("").alias("permalink"), F.col("text").alias("caption"), urls.alias("image_urls"), (F.col("doc_id") % 3 != 0).alias("valid"), F.col("source").alias("author"))
    return records.pass_through(rows, 7, "run").select("post_id", "caption", "batch_seq", F.size("image_urls").alias("n_images"), "author")


@query(r"select conv_id, turn, not regexp_matches(case when turn % 2 = 0 then '' else coalesce(text, '') end || case when turn % 3 = 0 then coalesce(role, '') else '' end, '\S') as empty from conversations")
def p10_text_empty(spark, sf_dir):
    text = F.when(F.col("turn") % 2 == 0, " \n").otherwise(F.col("text"))
    marks = F.array(F.lit(" "), F.when(F.col("turn") % 3 == 0, F.col("role")))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", records.text_empty(text, marks).alias("empty"))


@query("select event_id from events where case when user_id % 5 = 0 then true else user_id % 20 between 1 and 9 end")
def p12_retry_window(spark, sf_dir):
    """Rows of the batches to try again, at first also those of no known batch."""
    low, high, unknown = records.retry_window(9)
    seq = F.when(F.col("user_id") % 5 != 0, F.col("user_id") % 20)
    return table(spark, sf_dir, "events").where(records.in_window(seq, low, high, unknown)).select("event_id")


@query("select event_id, case event_type when 'click' then 'tap' when 'view' then 'look' else 'other' end as kind from events")
def p13_canonical_tags(spark, sf_dir):
    kind = t.canonical(F.concat(F.lit(" "), F.upper("event_type")), {"click": "tap", "view": "look"}, F.lit("other"))
    return table(spark, sf_dir, "events").select("event_id", kind.alias("kind"))


@query("select cast(l_partkey as varchar) || '.jpg' as image from lineitem group by 1 except select cast(p_partkey as varchar) || '.jpg' from part where p_partkey % 3 = 0")
def j4_done_filter(spark, sf_dir):
    """Images that have no finished page yet."""
    items = table(spark, sf_dir, "lineitem").select(F.concat(F.col("l_partkey").cast("string"), F.lit(".jpg")).alias("image")).distinct()
    done = table(spark, sf_dir, "part").where("p_partkey % 3 = 0").select(F.concat(F.col("p_partkey").cast("string"), F.lit(".jpg")).alias("image"))
    return queues.not_done(items, done, "image")


@query("with v as (select user_id, arg_max(event_type, event_id) as t from events where event_id % 3 = 0 group by user_id), i as (select user_id, arg_max(event_type, event_id) as t from events where event_id % 3 = 1 group by user_id having user_id not in (select user_id from v)), n as (select user_id, arg_max(event_type, event_id) as t, arg_max(value > 5, event_id) as ok from events where event_id % 3 = 2 group by user_id) select user_id as k, t, ok as is_valid from n union all select user_id, t, true from v where user_id not in (select user_id from n) union all select user_id, t, false from i where user_id not in (select user_id from n)")
def u3_two_sided(spark, sf_dir):
    """Rows move between the valid and the invalid side with their newest state."""
    e = table(spark, sf_dir, "events").withColumn("k", F.col("user_id").cast("string"))
    last = lambda part: e.where(F.col("event_id") % 3 == part).groupBy("k").agg(F.max_by("event_type", "event_id").alias("t"))
    valid = last(0)
    invalid = last(1).join(valid, "k", "left_anti")
    new = e.where("event_id % 3 = 2").select("k", F.col("event_type").alias("t"), (F.col("value") > 5).alias("is_valid"), "event_id")
    return records.upsert_two_sided(valid, invalid, new, "k", "event_id").select(F.col("k").cast("long").alias("k"), "t", "is_valid")


@query("with r as (select l_orderkey, l_partkey, case when l_linenumber = 1 then 's' || l_orderkey else '' end as story, 't' || l_partkey as tile from lineitem), k as (select tile, max(story) as story from r where story <> '' group by tile) select coalesce(nullif(r.story, ''), k.story, r.tile) as key, count(*) as n from r left join k on k.tile = r.tile group by 1")
def u5_rekey(spark, sf_dir):
    """Rows under their story's id, also those whose tile another row ties to a story."""
    li = table(spark, sf_dir, "lineitem")
    rows = li.select(F.when(F.col("l_linenumber") == 1, F.concat(F.lit("s"), F.col("l_orderkey").cast("string"))).otherwise("").alias("story"), F.concat(F.lit("t"), F.col("l_partkey").cast("string")).alias("tile"))
    return records.rekey(rows, "story", "tile").groupBy("key").agg(F.count("*").alias("n"))


@query("select l_orderkey as k, cast(least(count(distinct l_partkey), 3) as int) as n from lineitem group by l_orderkey")
def u7_distinct_capped(spark, sf_dir):
    """Each order's distinct parts, three of them at most: the limit is the operator's."""
    parts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_list(F.concat(F.lit(" "), F.col("l_partkey").cast("string"))).alias("p"))
    return parts.select("k", F.size(records.distinct_capped(F.col("p"), 3)).alias("n"))


@query(r"select page_id, case when page_id % 3 = 0 then 'https://s/groups/5/permalink/' || page_id || '/' when page_id % 3 = 1 then 'https://s/groups/' || page_id || '/posts/' || page_id || '/' else '' end as link from pages")
def t15_canonical_permalinks(spark, sf_dir):
    p = F.col("page_id").cast("string")
    url = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://x/story.php?story_fbid="), p, F.lit("&id=5#c"))).when(F.col("page_id") % 3 == 1, F.concat(F.lit("https://x/groups/"), p, F.lit("/posts/"), p, F.lit("/?ref=1"))).otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", t.canonical_permalink("https://s", url, F.lit("")).alias("link"))


@query("select doc_id, case when doc_id % 4 = 0 then 'none' when doc_id % 4 = 1 then 'label_dropped' when doc_id % 4 = 2 then 'recovered_to_orphan' else 'review' end as action, case when doc_id % 4 = 2 then 'dòng ' || doc_id else '' end as latin from documents")
def t22_headers(spark, sf_dir):
    i = F.col("doc_id")
    head = F.when(i % 4 == 0, "TRIỀU GIA LONG").when(i % 4 == 1, "TRIỀU GIA LONG\nTrích yếu").when(i % 4 == 2, F.concat(F.lit("triều gia long\ndòng "), i.cast("string"))).otherwise(F.concat(F.lit("trang "), i.cast("string")))
    x = pages.inspect_header(head)
    return table(spark, sf_dir, "documents").select("doc_id", x.alias("x")).select("doc_id", "x.action", "x.latin")


@query(r"select conv_id, turn, case when lb = '' or contains(tb, lb) then coalesce(text, '') when text is null or tt = '' then leak else leak || chr(10) || tt end as body from (select *, regexp_replace(leak, '\s+', '', 'g') as lb, regexp_replace(coalesce(text, ''), '\s+', '', 'g') as tb, regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g') as tt from (select *, case when turn % 3 = 0 then '' else coalesce(role, '') end as leak from conversations))")
def t23_prepend_once(spark, sf_dir):
    leak = F.when(F.col("turn") % 3 == 0, "").otherwise(F.col("role"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", t.prepend_once(F.col("text"), leak).alias("body"))


@query("select page_id, levenshtein(url, substr(url, 3)) as d from pages")
def m1_edit_distance(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", m.edit_distance(url, F.substring(url, F.lit(3), F.length(url))).cast("long").alias("d"))


@query("select event_id, case when value < 25 then 'abcd' when event_id % 2 = 0 then 'abcx' end as pick from events")
def m9_caption_pick(spark, sf_dir):
    """The caption decides between two readings that differ in one letter."""
    hint = F.when(F.col("value") < 25, "zd").when(F.col("event_id") % 2 == 0, "zx").otherwise("q")
    return table(spark, sf_dir, "events").select("event_id", m.caption_pick(F.lit("abcd"), F.lit("abcx"), hint, LETTERS).alias("pick"))


@query("select event_id, case when user_id % 3 = 0 then 2 when user_id % 3 = 1 then 1 else 0 end as n from events")
def m11_overlapping_lines(spark, sf_dir):
    r = F.col("user_id") % 3
    other = F.when(r == 0, F.array(F.lit("abcd"), F.lit("abzz"))).when(r == 1, F.array(F.lit("abcd"), F.lit("zzzz"))).otherwise(F.array(F.lit("xxxx")))
    return table(spark, sf_dir, "events").select("event_id", F.size(m.overlapping_lines(F.array(F.lit("abc"), F.lit("d")), other, 0.5, LETTERS)).alias("n"))


@query("select l_orderkey, l_linenumber, l_partkey, greatest(0, least(1000, cast(round_even(l_quantity * 10, 0) as int))) as ymin, greatest(0, least(1000, cast(round_even(l_extendedprice, 0) as int))) as xmin, round_even(greatest(0, least(1, l_discount * 20)), 4)::double as confidence from lineitem")
def l1_boxes(spark, sf_dir):
    b = layout.box(F.lit("x"), F.col("l_quantity") * 10, F.col("l_extendedprice"), F.lit(2000), F.lit(-5), F.lit(None).cast("string"), F.col("l_discount") * 20)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", b.alias("b")).select("l_orderkey", "l_linenumber", "l_partkey", "b.ymin", "b.xmin", "b.confidence")


@query("select l_orderkey, l_linenumber, l_partkey, [cast(round_even(l_quantity * 10, 0) as int), 100, cast(round_even(l_quantity * 10 + 20, 0) as int), 500]::varchar as bounds from lineitem")
def l1_polygon_bounds(spark, sf_dir):
    q = F.col("l_quantity")
    point = lambda x, y: F.array(F.lit(x).cast("double"), y)
    bounds = layout.polygon_bounds(F.array(point(200, q * 10), point(1000, q * 10 + 5), point(400, q * 10 + 20)), F.lit(2000.0), F.lit(1000.0))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.concat(F.lit("["), F.array_join(F.transform(bounds, lambda v: v.cast("string")), ", "), F.lit("]")).alias("bounds"))


@query("select event_id, case event_id % 4 when 0 then 'ink_text' when 1 then 'seal' when 2 then 'printed' else 'other' end as kind from events")
def l2_kinds(spark, sf_dir):
    """Kinds by shape and script: digits count as content here."""
    i = F.col("event_id") % 4
    text = F.when(i == 0, "1234").when(i == 1, "x").when(i == 2, "abcd efgh").otherwise(" ")
    b = layout.box(text, F.lit(100), F.lit(100), F.when(i == 0, 400).when(i == 1, 200).otherwise(150), F.when(i == 1, 200).when(i == 0, 150).otherwise(900), F.lit("x"), F.lit(1.0))
    return table(spark, sf_dir, "events").select("event_id", layout.kind_of(b, "0-9").alias("kind"))


@query("select l_orderkey as page, count(*) filter (l_linenumber <> 2) as n from lineitem group by l_orderkey")
def l3_normalised(spark, sf_dir):
    """Boxes of a page without those that have no text."""
    li = boxes(spark, sf_dir)
    emptied = li.withColumn("b", F.when(F.col("line") == 2, F.col("b").withField("text", F.lit(" ")).withField("kind", F.lit("main"))).otherwise(F.col("b")))
    return emptied.groupBy("page").agg(F.collect_list("b").alias("bs")).select("page", F.size(layout.normalise(F.col("bs"))).cast("long").alias("n"))


@query("select event_id, case event_id % 4 when 0 then 'ab,cd' when 1 then 'a,bcd' when 2 then 'ab,cd' else 'xy' end as lines from events")
def f5_cluster_or_refined(spark, sf_dir):
    """Refined lines stay where they hold the cluster's text in order or another text, else the cluster's."""
    i = F.col("event_id") % 4
    refined = F.when(i == 0, F.array().cast("array<string>")).when(i == 1, F.array(F.lit("a"), F.lit("bcd"))).when(i == 2, F.array(F.lit("cd"), F.lit("ab"))).otherwise(F.array(F.lit("xy")))
    return table(spark, sf_dir, "events").select("event_id", F.array_join(fuse.keep_split_or_cluster(F.array(F.lit("ab"), F.lit("cd")), refined, "a-z"), ",").alias("lines"))


@query("select event_id, case event_id % 3 when 0 then 'b' when 1 then 'b' else 'a' end as track from events")
def f7_pick_track(spark, sf_dir):
    i = F.col("event_id") % 3
    a = F.when(i == 0, F.array().cast("array<string>")).when(i == 1, F.array(*map(F.lit, "abcd"))).otherwise(F.array(F.lit("ab"), F.lit("cd")))
    return table(spark, sf_dir, "events").select("event_id", fuse.pick_track(a, F.array(F.lit("ab"), F.lit("cd")), "a-z")["track"].alias("track"))


@query("select event_id, '[https://cdn.x/' || event_id || '.jpg, https://cdn.x/in' || user_id || '.png]' as images, strftime(to_timestamp(1500000000 + event_id)::timestamp, '%Y-%m-%dT%H:%M:%S+00:00') as posted_at, case when event_id % 2 = 0 then 'own' else 'u' || user_id end as author from events")
def t25_nested_media(spark, sf_dir):
    """Images, time and author of nested objects; a second address of an image and a video are no images of their own."""
    i, u = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    inner = F.concat(F.lit('{"media": [{"image": {"uri": "https://cdn.x/in'), u, F.lit('.png"}}, {"image": {"uri": "https://cdn.x/'), i, F.lit('.jpg?b=2"}}, {"url": "https://cdn.x/v.mp4"}], "timestamp": 1600000000}'))
    head = F.when(F.col("event_id") % 2 == 0, '"username": " own ", ').otherwise("")
    node = F.concat(F.lit("{"), head, F.lit('"actors": [{"name": "u'), u, F.lit('"}], "src": "https://cdn.x/'), i, F.lit('.jpg", "creation_time": '), (F.col("event_id") + 1_500_000_000).cast("string"), F.lit(', "story": '), inner, F.lit("}"))
    got = tables.nested_media(table(spark, sf_dir, "events").select("event_id", node.alias("node")), "event_id", "node")
    plain = F.concat(F.lit("["), F.array_join(F.transform("image_urls", lambda x: F.substring_index(x, "?", 1)), ", "), F.lit("]"))
    return got.select("event_id", plain.alias("images"), "posted_at", "author")


@query("select event_id, case event_id % 4 when 3 then false else true end as mine from events")
def t26_belongs_to_group(spark, sf_dir):
    i = F.col("event_id") % 4
    node = F.when(i == 0, '{"a": 1}').when(i == 1, '{"group": {"x": 2, "id": "7"}}').when(i == 2, '{"to": {"id": "8"}, "target_group": {"id": "7"}}').otherwise('{"owning_profile": {"id": "8"}}')
    return table(spark, sf_dir, "events").select("event_id", t.belongs_to_group(node, F.lit("7")).alias("mine"))


@query("select event_id, event_id % 3 <> 2 as parse_ok, cast(case event_id % 3 when 0 then 12 else -1 end as bigint) as printed_page, case event_id % 3 when 0 then 'han_nom:' || event_type when 1 then 'mixed:{\"page_header\": \"h\", \"blocks\": 3}' else 'mixed:no object' end as first from events")
def t21_parse_body(spark, sf_dir):
    """A model's replies about pages: with blocks, without, and no object at all."""
    i = F.col("event_id") % 3
    good = F.concat(F.lit('<think>{}</think>```json\n{"printed_page": "p. 12", "blocks": [{"script": " HAN_NOM", "text": " '), F.col("event_type"), F.lit(' "}, {"script": "x", "text": ""},]}\n```'))
    reply = F.when(i == 0, good).when(i == 1, '{"page_header": "h", "blocks": 3}').otherwise(" no object ")
    x = table(spark, sf_dir, "events").select("event_id", t.parse_body(reply).alias("x"))
    first = F.get("x.blocks", F.lit(0))
    return x.select("event_id", "x.parse_ok", F.coalesce("x.printed_page", F.lit(-1)).alias("printed_page"), F.concat(first["script"], F.lit(":"), first["text"]).alias("first"))


@query("select event_id, case when event_id % 2 = 0 then '1:a,3:' || event_type else '' end as entries from events")
def t21_parse_entries(spark, sf_dir):
    i = F.col("event_id") % 2
    good = F.concat(F.lit('{"entries": [{"stt": 3, "de_tai": "'), F.col("event_type"), F.lit('"}, {"stt": "x", "de_tai": "b"}, {"stt": "1", "de_tai": " a "}, {"stt": 0}]}'))
    x = t.parse_entries(F.when(i == 0, good).otherwise("none"))
    return table(spark, sf_dir, "events").select("event_id", F.array_join(F.transform(x, lambda e: F.concat(e["number"].cast("string"), F.lit(":"), F.trim(e["de_tai"]))), ",").alias("entries"))


_EVALUATED = """
  select event_id, array_to_string(list_filter([a, b, case when user_id % 4 = 0 and coalesce(a, '') <> 'col_order_reversed' and coalesce(b, '') <> 'col_order_reversed' then 'col_order_reversed' end], lambda x: x is not null), ',') as codes, conf, given
  from (select *, case when i in ('ocr_garbage', 'col_order_reversed', 'needs_hitl', 'semantic_break') and i <> coalesce(a, '') then i end as b
        from (select event_id, user_id, case event_id % 5 when 0 then 'caption_conflict' when 1 then 'order_splice' when 2 then 'semantic_break' end as a,
                     case event_id % 7 when 0 then 'ocr_garbage' when 1 then 'col_order_reversed' when 2 then 'needs_hitl' when 3 then 'semantic_break' else 'odd' end as i,
                     round_even(greatest(0, least(1, value / 20)), 4)::double as conf, case event_id % 3 when 0 then 'ok' when 1 then 'merged' else 'what' end as given from events))
"""
_DERIVED = "case when contains(codes, 'ocr_garbage') then 'needs_re_ocr' when contains(codes, 'needs_hitl') or (conf <= 0.5 and contains(codes, 'semantic_break')) or (contains(codes, 'caption_conflict') and conf < 0.6) then 'needs_hitl' when contains(codes, 'order_splice') or contains(codes, 'semantic_break') or contains(codes, 'col_order_reversed') then 'refined' else 'ok' end"


@query(f"select event_id, codes, case when given = 'what' or d = 'needs_re_ocr' or (d = 'needs_hitl' and given = 'ok') then d else given end as status from (select *, {_DERIVED} as d from ({_EVALUATED}))")
def f17_evaluate(spark, sf_dir):
    """Judgements of pages: flags and issues united, reversed columns noticed, states by precedence."""
    i, j = F.col("event_id") % 5, F.col("event_id") % 7
    flags = F.array(F.when(i == 0, "caption_conflict").when(i == 1, "order_splice").when(i == 2, "semantic_break").otherwise("nothing"))
    issues = F.array(F.when(j == 0, "ocr_garbage").when(j == 1, "col_order_reversed").when(j == 2, "needs_hitl").when(j == 3, "semantic_break").otherwise("odd"))
    given = F.when(F.col("event_id") % 3 == 0, "ok").when(F.col("event_id") % 3 == 1, "merged").otherwise("what")
    order = F.when(F.col("user_id") % 2 == 0, "rtl_columns").otherwise("grid")
    truth = F.when(F.col("user_id") % 4 == 0, "ab cd").otherwise("cdab")
    x = fuse.evaluate(flags, issues, given, F.col("value") / 20, order, F.lit("ab-cd"), truth, "a-z")
    return table(spark, sf_dir, "events").select("event_id", x.alias("x")).select("event_id", F.array_join("x.codes", ",").alias("codes"), "x.status")
