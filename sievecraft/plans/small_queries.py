"""Queries of small text, pair and page operators that no larger query shows by itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import pairs as m
from ..functions import text as t
from ..operators import pages, rollup
from .adapters import LETTERS
from .catalogue import query, table
from .pair_queries import _FOLDED, _SHARED, turns

_LONGEST = "coalesce(list_max(flatten([[case when contains({b}, {a}[i:j]) then j - i + 1 else 0 end for j in range(i, length({a}) + 1)] for i in range(1, length({a}) + 1)])), 0)"


@query("select doc_id, 'a' || doc_id || '：' || n_chars as text from documents")
def t3_verses(spark, sf_dir):
    """Colons go, but for those of verse references."""
    x = F.concat(F.lit("a:"), F.col("doc_id").cast("string"), F.lit(":"), F.col("n_chars").cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", t.restore_verses(F.replace(t.protect_verses(x), F.lit(":"), F.lit(""))).alias("text"))


@query("select doc_id, source || lang || '，' || doc_id as text from documents")
def t4_icons(spark, sf_dir):
    x = F.concat("source", F.lit("❤"), "lang", F.lit("★，☆"), F.col("doc_id").cast("string"), F.lit("👍"))
    return table(spark, sf_dir, "documents").select("doc_id", t.strip_icons(x).alias("text"))


@query("select event_id, case when event_id % 9 >= 6 then 'a' else repeat('a', event_id % 9) end || event_type as text from events")
def t5_repeats(spark, sf_dir):
    x = F.concat(F.repeat(F.lit("a"), (F.col("event_id") % 9).cast("int")), "event_type")
    return table(spark, sf_dir, "events").select("event_id", t.collapse_repeats(x).alias("text"))


@query("select doc_id, source || chr(10) || lang as text from documents")
def t6_side_text(spark, sf_dir):
    x = F.concat(F.lit("[seal]\n  "), "source", F.lit("👍 \n\n"), "lang", F.lit("\n12 cm"))
    return table(spark, sf_dir, "documents").select("doc_id", t.clean_side_text(x).alias("text"))


@query("select doc_id, translate(cast(doc_id as varchar), '0123456789', '雲萬與書親東絲兩嚴修') as text from documents")
def t8_norm(spark, sf_dir):
    """Ids written in simplified characters and a variant, in the form in which texts are compared."""
    x = F.concat(F.lit("x "), F.translate(F.col("doc_id").cast("string"), "0123456789", "云万与书亲东丝两严脩"))
    return table(spark, sf_dir, "documents").select("doc_id", t.norm(x).alias("text"))


@query("select event_id, case when c = '' then 'empty' when n >= 4 or n / length(c) >= 0.5 then 'quote' else 'unrelated' end as align from (select event_id, c, len(list_filter(string_split(c, ''), lambda x: x <> '' and contains('click', x))) as n from (select event_id, case when event_id % 5 = 0 then '' else event_type end as c from events))")
def t10_caption_use(spark, sf_dir):
    allowed = F.array(*[F.lit(x) for x in "click"])
    c = F.when(F.col("event_id") % 5 == 0, "").otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", t.caption_use(c, allowed, "a-z")["align"].alias("align"))


_CAPTIONS = "select user_id, event_type, case when event_id % 3 = 0 then '字' else 'v' end || event_id as text, event_id % 3 <> 0 as foreign_text from events"


@query(f"select user_id, text as caption from (select *, row_number() over (partition by user_id order by foreign_text, case event_type when 'error' then 1 when 'click' then 2 else 3 end, -length(text), text) as r from ({_CAPTIONS})) where r = 1")
def t24_best_caption(spark, sf_dir):
    text = F.concat(F.when(F.col("event_id") % 3 == 0, "字").otherwise("v"), F.col("event_id").cast("string"))
    return pages.best_caption(table(spark, sf_dir, "events").withColumn("text", text), "user_id", "event_type", "text", ("error", "click"))


_REPEATED = "select event_id, repeat('x', user_id % 5) || event_type as a, repeat('x', event_id % 4) || event_type as b from events"


@query(f"select event_id, len(list_filter(list_distinct(string_split(a || b, '')), lambda c: c <> '' and greatest(length(a) - length(replace(a, c, '')), length(b) - length(replace(b, c, ''))) / greatest(length(a), length(b), 1) >= 0.4 and length(a) - length(replace(a, c, '')) <> length(b) - length(replace(b, c, '')))) > 0 as differ from ({_REPEATED})")
def m8_repeats_differ(spark, sf_dir):
    x = lambda c: F.concat(F.repeat(F.lit("x"), c.cast("int")), "event_type")
    return table(spark, sf_dir, "events").select("event_id", m.repeats_differ(x(F.col("user_id") % 5), x(F.col("event_id") % 4), "a-z").alias("differ"))


@query(f"""
with x as (select event_id, event_type as l, reverse(event_type) as r, substr(event_type, 2) as g, case when event_id % 2 = 0 then event_type else reverse(event_type) end as w from events),
     n as (select event_id, {_LONGEST.format(a="l", b="w")} as a, {_LONGEST.format(a="r", b="w")} as b, {_LONGEST.format(a="g", b="w")} as c from x)
select event_id, cast(a as int) as ltr_common, cast(b as int) as rtl_common, cast(c as int) as grid_common,
  case when (list_reverse_sort([a, b, c]))[1] = (list_reverse_sort([a, b, c]))[2] then 'tie' when a = greatest(a, b, c) then 'ltr_columns' when b = greatest(a, b, c) then 'rtl_columns' else 'grid' end as best_order
from n
""")
def m12_best_order(spark, sf_dir):
    l = F.col("event_type")  # noqa: E741
    truth = F.when(F.col("event_id") % 2 == 0, l).otherwise(F.reverse(l))
    return table(spark, sf_dir, "events").select("event_id", m.best_order(l, F.reverse(l), F.substring(l, F.lit(2), F.length(l)), truth, "a-z").alias("x")).select("event_id", "x.*")


@query("select event_id, case when event_id % 4 in (0, 3) then event_type else '' end as text from events")
def f13_recommend_gate(spark, sf_dir):
    """Recommendations that reuse a's text, invent a character, are both texts in a row, and are b's."""
    a, k = F.col("event_type"), F.col("event_id") % 4
    b = F.reverse(a)
    given = F.when(k == 1, F.concat(a, F.lit("q"))).when(k == 2, F.concat(a, b)).otherwise(a)
    return table(spark, sf_dir, "events").select("event_id", pages.accept_recommendation(a, b, given, "a-z").alias("text"))


_TOLD = f"select conv_id, turn, a, b, case when a = '' and b = '' then 0 when a = '' then 1 else round_even(levenshtein(a, b) / length(a), 4) end::double as cer, case when length(a) + length(b) = 0 then 1 else round_even(2.0::double * coalesce({_SHARED}, 0) / (length(a) + length(b)), 4) end::double as bag from ({_FOLDED})"


@query(f"select conv_id, turn, cer, bag, cer <= 0.08 or a = b as agree from ({_TOLD})")
def f19_compare_to_truth(spark, sf_dir):
    rows = turns(spark, sf_dir).withColumn("key", F.concat_ws("-", "conv_id", "turn"))
    got = pages.compare_to_truth(rows.select("key", "conv_id", "turn", F.col("b").alias("ground_truth")), rows.select("key", F.col("a").alias("truth")), "key", LETTERS)
    return got.select("conv_id", "turn", "cer", "bag", "agree")


@query("select value, count(*) as n from (select unnest([event_type, 'u' || user_id % 3]) as value from events) group by value")
def a3_flag_histogram(spark, sf_dir):
    flags = F.array("event_type", F.concat(F.lit("u"), (F.col("user_id") % 3).cast("string")))
    return rollup.histogram(table(spark, sf_dir, "events").select(flags.alias("flags")), "flags")
