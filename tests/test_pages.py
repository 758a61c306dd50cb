"""Recommendations, relocking, reviews."""

import pytest
from pyspark.sql import functions as F

from sievecraft.operators import pages


def arr(*x):
    return F.array(*map(F.lit, x)) if x else F.array().cast("array<string>")


def test_recommendations(one):
    rec = pages.accept_recommendation(F.col("a"), F.col("b"), F.col("r"))
    assert one(rec, a="春風\n又綠", b="春風又緑", r="春風又綠") == "春風\n又綠"
    assert one(rec, a="春風", b="又綠", r="春風又綠") == ""
    assert one(rec, a="春風", b="春雨", r="春雪") == ""
    assert one(rec, a="春風", b="春雨", r="春雨") == "春雨"
    assert one(rec, a="", b="", r="春") == ""
    assert one(pages.fallback(F.lit("春"), F.lit("雨"), F.lit("B"))) == {"text": "雨", "source": "fallback_b"}
    assert one(pages.fallback(F.lit(""), F.lit(""), F.lit("a")))["source"] == "glm_empty_ab"


def test_relock(one):
    assert one(pages.relock(arr("甲乙丙", "丁戊己"), arr("丁戊己", "甲乙丙"))) == ["甲乙丙", "丁戊己"]
    assert one(pages.relock(arr("甲乙丙丁", "戊己"), arr("戊己", "甲乙", "丙丁"))) == ["甲乙", "丙丁", "戊己"]
    assert one(pages.relock(arr("甲乙", "丙丁"), arr("甲乙丙丁"))) == ["甲乙丙丁"]
    assert one(pages.relock(arr("甲乙"), arr("甲癸"))) == ["甲乙"] and one(pages.relock(arr("甲"), arr())) == ["甲"]


def test_small_ones(spark, one):
    spans = F.array(F.struct(F.lit("x").alias("a"), F.lit("y").alias("b"), F.lit("partial").alias("reason")))
    assert one(pages.span_reason(spans, F.lit("x"), F.lit("y"))) == "partial" and one(pages.span_reason(spans, F.lit("x"), F.lit("z"))) == ""
    assert one(pages.needs_refetch(F.lit(True), F.lit("missing_image"))) is True and one(pages.needs_refetch(F.lit(True), F.lit(None).cast("string"))) is False
    rows = spark.createDataFrame([("p", "", ["u2"])], "post_id string, caption string, image_urls array<string>")
    prior = spark.createDataFrame([("p", "春風又綠", ["u1"], False)], "post_id string, caption string, image_urls array<string>, valid boolean")
    got = pages.prior_fill(rows, prior, "post_id").first()
    assert (got.caption, got.image_urls, got.valid, got.counts) == ("春風又綠", ["u1", "u2"], True, True)
    c = spark.createDataFrame([(1, "title", "a longer latin text"), (1, "text", "春"), (2, "x", " ")], "k int, name string, t string")
    assert [tuple(r) for r in pages.best_caption(c, "k", "name", "t", ("title", "text")).collect()] == [(1, "春")]
    flags = one(pages.judge_flags(*[F.lit(v) for v in (True, False, False, "model", "A", True, "x", False, False)]))
    assert flags == ["glm_agree_fuse", "glm_gate_ok", "glm_pick_a"]


@pytest.mark.parametrize("text, want", [
    ("", (None, None, "", "", "none", False)),
    ("Triều  Gia Long", ("TRIỀU GIA LONG", "Triều  Gia Long", "", "", "normalized", False)),
    ("TRIỀU MINH MỆNH", ("TRIỀU MINH MỆNH", "TRIỀU MINH MỆNH", "", "", "none", False)),
    ("Mục lạc châu bản triều Nguyễn\nTrích yếu", ("MỤC LỤC CHÂU BẢN TRIỀU NGUYỄN", "Mục lạc châu bản triều Nguyễn\nTrích yếu", "", "", "label_dropped", False)),
    ("Trang lạ\n春風", ("Trang lạ\n春風", "Trang lạ\n春風", "", "", "review", True)),
    ("TRIỀU GIA LONG\n春風   gió xuân\n明月", ("TRIỀU GIA LONG", "TRIỀU GIA LONG\n春風   gió xuân\n明月", "春風\n明月", "gió xuân", "recovered_to_orphan", True)),
    ("TRIỀU GIA LONG\n春風 gió", ("TRIỀU GIA LONG\n春風 gió", "TRIỀU GIA LONG\n春風 gió", "", "", "review", True)),
    ("TRIỀU GIA LONG\n1802", ("TRIỀU GIA LONG\n1802", "TRIỀU GIA LONG\n1802", "", "", "review", True)),
])
def test_headers(one, text, want):
    got = one(pages.inspect_header(F.lit(text)))
    assert tuple(got[k] for k in ("page_header", "raw_header", "han", "latin", "action", "suspicious")) == want
