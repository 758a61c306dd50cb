"""Queries of reading order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import layout
from .adapters import pages
from .catalogue import query

_BOX = """
  select l_orderkey as page, strftime(l_shipdate, '%Y-%m-%d') || ' ' || l_partkey as text,
    (l_partkey * 53 + l_linenumber * 17) % 900 as ymin, (l_partkey * 37 + l_suppkey * 11) % 900 as xmin,
    (l_partkey * 53 + l_linenumber * 17) % 900 + 20 + l_suppkey % 80 as ymax, (l_partkey * 37 + l_suppkey * 11) % 900 + 10 + l_partkey % 60 as xmax,
    case l_returnflag when 'A' then 'margin' when 'R' then 'seal' else 'ink_text' end as kind, round_even(greatest(0, least(1, 1 - l_discount * 5)), 4)::double as conf
  from lineitem
"""
_TEXT = "string_agg(text, '\n' order by {}, text, ymin, xmin, ymax, xmax, kind, conf)"


@query(f"select page, {_TEXT.format('xmin, ymin')} as ltr, {_TEXT.format('-xmax, ymin')} as rtl, {_TEXT.format('ymin, xmin')} as grid from ({_BOX}) group by page")
def l5_simple_orders(spark, sf_dir):
    b = F.col("boxes")
    return pages(spark, sf_dir).select("page", layout.texts(layout.ltr(b)).alias("ltr"), layout.texts(layout.rtl(b)).alias("rtl"), layout.texts(layout.grid(b)).alias("grid"))


@query(f"select page, count(*) filter (kind = 'ink_text') as n_main, count(distinct text) filter (kind <> 'ink_text') as n_side from ({_BOX}) group by page")
def l4_main_and_side(spark, sf_dir):
    side = layout.side_text(F.col("boxes"))
    n = F.when(side == "", 0).otherwise(F.size(F.split(side, "\n")))
    return pages(spark, sf_dir).select("page", F.size(layout.main_boxes(F.col("boxes"))).cast("long").alias("n_main"), n.cast("long").alias("n_side"))


@query(f"select page, round_even(cast(sum(conf * n) / sum(n) as decimal(18, 10)), 4)::double as conf from (select page, conf, length(regexp_replace(text, '[^0-9]', '', 'g')) as n from ({_BOX})) group by page")
def l13_weighted_confidence(spark, sf_dir):
    return pages(spark, sf_dir).select("page", layout.weighted_confidence(F.col("boxes"), "0-9").alias("conf"))


@query(f"""
with o as (select page, list((ymin + ymax) / 2 order by (ymin + ymax) / 2) as c, list(greatest(ymax - ymin, 1) order by greatest(ymax - ymin, 1)) as h from ({_BOX}) group by page),
     g as (select page, len(c) as n, [c[i + 1] - c[i] for i in range(1, len(c))] as gaps, greatest(120.0, 1.5 * h[len(h) // 2 + 1]) as need from o),
     w as (select page, n, need, list_max(gaps) as widest, list_position(gaps, list_max(gaps)) as k from g)
select page, case when n >= 4 and widest > 0 and widest >= need and k >= 2 and n - k >= 2 then k || ',' || (n - k) else cast(n as varchar) end as sizes from w
""")
def l6_tiers(spark, sf_dir):
    sizes = F.transform(layout.tiers(F.col("boxes")), lambda x: F.size(x).cast("string"))
    return pages(spark, sf_dir).select("page", F.array_join(sizes, ",").alias("sizes"))


@query()
def l9_reading_order(spark, sf_dir):
    b = layout.reading_order(F.col("boxes"), keep="0-9")
    return pages(spark, sf_dir).select("page", layout.texts(b).alias("text"), F.size(b).alias("n"))


@query()
def l10_column_lines(spark, sf_dir):
    return pages(spark, sf_dir).select("page", F.array_join(layout.column_lines(F.col("boxes")), "\n").alias("lines"), layout.is_per_character(F.col("boxes"), "0-9").alias("per_character"))


@query()
def l11_merge_passes(spark, sf_dir):
    """Even boxes of a page as one pass, odd ones, moved a little, as the other."""
    moved = F.transform("boxes", lambda b: b.withField("xmin", b["xmin"] + 3).withField("confidence", b["confidence"] * 0.9))
    merged = layout.merge_passes(F.filter("boxes", lambda b, i: i % 2 == 0), F.filter(moved, lambda b, i: i % 3 != 1), keep="0-9")
    return pages(spark, sf_dir).select("page", F.size(merged).alias("n"), F.size(F.filter(merged, lambda x: x["source"] == "b")).alias("n_b"))


@query()
def l12_text_rows(spark, sf_dir):
    return pages(spark, sf_dir).select("page", F.array_join(layout.text_rows(F.col("boxes")), "\n").alias("lines"))


@query()
def l12_page_text(spark, sf_dir):
    """Pages whose tall boxes of digits are columns and whose other boxes are lines."""
    return pages(spark, sf_dir).select("page", layout.page_text(F.col("boxes"), "0-9").alias("text"))
