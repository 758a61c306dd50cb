"""Queries of text cleaning and text scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as t
from ..sources.tables import feed_candidates, walk_json
from .adapters import LETTERS
from .catalogue import query, table

_SIZE = t.SIZE_MARK.replace("'", "''")


@query(f"""
select doc_id, length(c) as n, a <> x as device, b <> a as size, c <> b as tag from (
  select *, regexp_replace(b, '{t.TAGS}', '', 'g') as c from (
    select *, regexp_replace(regexp_replace(regexp_replace(a, '{_SIZE}', '', 'g'), '{t.LENGTH_MARK}', '', 'g'), '{t.GRID_MARK}', '', 'g') as b from (
      select *, regexp_replace(regexp_replace(x, '{t.DEVICE_LINE}', '', 'g'), '{t.TIMESTAMP}', '', 'g') as a from (
        select doc_id, coalesce(text, '') || ' 2024-01-02 10:00 3x4cm ' || (doc_id % 7) || '格 [seal]' as x from documents))))""")
def t1_strip_noise(spark, sf_dir):
    marked = F.concat(F.coalesce("text", F.lit("")), F.lit(" 2024-01-02 10:00 3x4cm "), (F.col("doc_id") % 7).cast("string"), F.lit("格 [seal]"))
    d = table(spark, sf_dir, "documents").select("doc_id", t.strip_noise(marked).alias("s"))
    met = lambda rule: F.array_contains("s.rules", rule)
    return d.select("doc_id", F.length("s.text").cast("long").alias("n"), met("device_wm_or_timestamp").alias("device"), met("seal_size_or_grid").alias("size"), met("seal_or_tech_tag").alias("tag"))


@query()
def t2_clean_main_text(spark, sf_dir):
    """Main text cleaned with all letters kept: how long it is, and why it changed."""
    d = table(spark, sf_dir, "documents").select("doc_id", t.clean_main_text(F.col("text"), letters=r"(?!)").alias("c"))
    return d.select("doc_id", F.length("c.text").alias("n"), "c.log")


@query()
def t7_clean_pair(spark, sf_dir):
    d = table(spark, sf_dir, "conversations")
    return d.select("conv_id", "turn", t.clean_pair(F.col("text"), F.col("role")).alias("c")).select("conv_id", "turn", F.length("c.main").alias("n_main"), "c.side", "c.log", "c.changed")


@query(r"select doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '(?i)https?://\S+', ' ', 'g'), '[#＃][\p{L}\p{N}_]+', ' ', 'g'), '@[\p{L}\p{N}_.]+', ' ', 'g'), '[^A-Za-z\s]', ' ', 'g'), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g') as kept from documents")
def t9_strip_caption_noise(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.strip_caption_noise(F.col("text"), LETTERS).alias("kept"))


@query(r"select doc_id, regexp_replace(lower(regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g')), '\s+', ' ', 'g') as label from documents")
def t11_normalise_label(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.normalise_label(F.col("text")).alias("label"))


@query("select event_id, date_trunc('day', ts)::timestamp as day from events")
def t12_parse_date(spark, sf_dir):
    ts = F.col("ts")
    text = F.when(F.col("event_id") % 3 == 0, F.date_format(ts, "yyyy/M/d")).when(F.col("event_id") % 3 == 1, F.date_format(ts, "MMMM d, yyyy")).otherwise(F.date_format(ts, "d MMM yyyy"))
    return table(spark, sf_dir, "events").select("event_id", t.parse_date(F.concat(F.lit("on "), text)).cast("timestamp_ntz").alias("day"))


@query("select event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S+00:00') as at from events")
def t13_unix_seconds(spark, sf_dir):
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string")
    return table(spark, sf_dir, "events").select("event_id", t.iso_utc(t.parse_unix_seconds(seconds)).alias("at"))


@query("select doc_id, cast(doc_id + 10000000 as varchar) as post_id from documents")
def t14_decode_post_id(spark, sf_dir):
    number = (F.col("doc_id") + 10_000_000).cast("string")
    raw = F.when(F.col("doc_id") % 3 == 0, number).when(F.col("doc_id") % 3 == 1, F.base64(F.concat(F.lit("S:_I61:VK:"), number).cast("binary"))).otherwise(F.rtrim(F.base64(number.cast("binary")), F.lit("=")))
    return table(spark, sf_dir, "documents").select("doc_id", t.decode_post_id(raw).alias("post_id"))


@query("select page_id, split_part(url, '?', 1) as base, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)', 1)) as host, substr(regexp_replace(url, '[^0-9A-Za-z_-]', '_', 'g'), 1, 64) as safe, coalesce(nullif('.' || regexp_extract(lower(url), '\\.(png|webp|gif)(?:$|\\?)', 1), '.'), '.jpg') as ext from pages")
def t15_url_parts(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", t.url_base(u).alias("base"), t.url_host(u).alias("host"), t.safe_id(u).alias("safe"), t.image_extension(u).alias("ext"))


@query("select page_id, case when page_id % 2 = 0 then 'https://site.example/groups/9/permalink/' || page_id || '/' else 'https://site.example/p/' || page_id end as link from pages")
def t16_choose_link(spark, sf_dir):
    p = F.col("page_id").cast("string")
    have = F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(F.concat(F.lit("https://site.example/p/"), p))
    return table(spark, sf_dir, "pages").select("page_id", t.choose_link("https://site.example", F.lit("9"), p, have).alias("link"))


@query("select doc_id, md5(substr(coalesce(source, ''), 1, 40) || '|' || substr(coalesce(text, ''), 1, 180) || '|' || 'https://x/' || doc_id) as id from documents")
def t17_content_id(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", t.content_id(F.col("source"), F.col("text"), F.concat(F.lit("https://x/"), F.col("doc_id").cast("string"), F.lit("?a=1"))).alias("id"))


@query("select conv_id, turn, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', 1 + (position(substr(h, 17, 1) in '0123456789abcdef') - 1) % 4, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) as id from (select conv_id, turn, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(conv_id || '|' || turn)) as h from conversations)")
def t18_name_uuid(spark, sf_dir):
    name = F.concat_ws("|", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", t.name_uuid(F.lit("6ba7b810-9dad-11d1-80b4-00c04fd430c8"), name).alias("id"))


@query("select event_id, cast(json_extract(props, '$.k') as int) as k from events")
def t19_lenient_json(spark, sf_dir):
    reply = F.concat(F.lit("<think>{no}</think>\n```json\n"), F.regexp_replace("props", r"\}$", ",}"), F.lit("\n```"))
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object(t.json_object_text(reply), "$.k").cast("int").alias("k"))


@query("select event_id, cast(regexp_extract(props, '(\\d+)', 1) as bigint) + (event_id % 2) * 70000000000 as n from events")
def t20_optional_int(spark, sf_dir):
    """Numbers in texts, every second one beyond 32 bits."""
    plain = F.regexp_extract("props", r"(\d+)", 1).cast("long")
    text = F.when(F.col("event_id") % 2 == 1, F.concat(F.lit("no. "), (plain + 70_000_000_000).cast("string"), F.lit(" of 9"))).otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", t.optional_int(text).alias("n"))


@query("select doc_id, case when n = 0 then 0.0::double else round_even(l / n, 6)::double end as latin from (select doc_id, length(regexp_replace(coalesce(text, ''), '[\\s\\x{85}\\x{A0}]', '', 'g')) as n, length(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')) as l from documents)")
def t27_script_ratios(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.bround(t.script_ratios(F.col("text"))["latin"], 6).alias("latin"))


@query("select doc_id, l >= 8 or (l >= 6 and l >= 0.4) as heavy from (select doc_id, length(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')) as l from documents)")
def p11_latin_heavy(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.latin_heavy(F.col("text")).alias("heavy"))


@query("select event_id, cast(event_id as varchar) as post_id, 'm' || event_id as message, cast(2000000000 as bigint) as created from events where event_id % 3 <> 2")
def s6_feed_candidates(spark, sf_dir):
    """Posts nested at different depths of a feed's JSON."""
    e = F.col("event_id").cast("string")
    node = F.concat(F.lit('{"post_id": "'), e, F.lit('", "creation_time": 2000000000, "message": {"text": "m'), e, F.lit('"}}'))
    doc = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"data": {"edges": [{"node": '), node, F.lit("}]}}"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("["), node, F.lit("]"))).otherwise(F.lit('{"broken": '))
    return feed_candidates(table(spark, sf_dir, "events").select("event_id", doc.alias("doc")), "event_id", "doc")


@query("select event_id, '$.k' as path, cast(json_extract(props, '$.k') as int) as k from events")
def s6_walk_json(spark, sf_dir):
    w = walk_json(table(spark, sf_dir, "events").select("event_id", "props"), "event_id", "props")
    return w.where("depth = 1").select("event_id", "path", F.expr("try_variant_get(value, '$', 'int')").alias("k"))
