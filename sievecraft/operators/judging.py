"""The log row of a judged page: what was recommended, how it was voted on, and how near it is to the other texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import lines, strip
from ..functions.pairs import bag_dice, cer, clamp
from ..functions.text import HAN, clean_main_text, compact, norm, to_traditional
from .fuse import positional_picks, review_bucket, vote_score
from .pages import accept_recommendation, judge_flags


def verses(text: Column, keep: str = HAN) -> Column:
    """Lines that hold content characters."""
    return F.size(F.filter(lines(text), lambda t: compact(t, keep) != ""))


def vote(rows: DataFrame, keep: str = HAN) -> DataFrame:
    """rows (text_a, text_b, recommend, pick, source, confidence, dropped, gate_ok) with ``vote``, the measures of which reading won."""
    a, b, given = (compact(to_traditional(F.col(c)), keep) for c in ("text_a", "text_b", "recommend"))
    rows = rows.withColumn("_gated", accept_recommendation(F.col("text_a"), F.col("text_b"), F.col("recommend"), keep))
    rows = rows.withColumns({"_a": a, "_b": b, "_r": compact(to_traditional(F.col("_gated")), keep), "_given": given}).withColumn("_p", positional_picks(F.col("text_a"), F.col("text_b"), F.col("_gated"), keep))
    p, c = F.col("_p"), F.col
    pick = F.lower(strip(F.coalesce("pick", F.lit(""))))
    count = lambda t, ch: F.length(t) - F.length(F.replace(t, ch, F.lit("")))
    union = F.aggregate(F.array_distinct(F.split(F.concat("_a", "_b"), "")), F.lit(0), lambda n, ch: n + F.when(ch == "", 0).otherwise(F.greatest(count(c("_a"), ch), count(c("_b"), ch))))
    mix = (p["n_pick_a"] > 0) & (p["n_pick_b"] > 0) & (c("_r") != c("_a")) & (c("_r") != c("_b"))
    mismatch = ((pick == "a") & (p["n_pick_b"] > p["n_pick_a"])) | ((pick == "b") & (p["n_pick_a"] > p["n_pick_b"]))
    delta = F.abs(verses(c("_gated"), keep) - verses(c("text_a"), keep))
    rows = rows.withColumns({"_mix": mix, "_mismatch": mismatch, "_delta": delta, "_union": union, "_source": F.coalesce("source", F.lit("")), "_confidence": clamp(c("confidence"))})
    score = vote_score(c("gate_ok"), c("_source"), c("_confidence"), c("dropped"), c("_mismatch"))
    empty = (c("_source") == "glm_empty_ab") | ((c("_r") == "") & (c("_a") == "") & (c("_b") == ""))
    rows = rows.withColumn("_score", score)
    bucket = review_bucket(c("_source"), empty, c("_confidence"), c("_mismatch"), c("_delta"), c("gate_ok"), c("_mix"), p["n_disagree"], c("_score"))
    concat = (c("_a") != "") & (c("_b") != "") & c("_given").isin(F.concat("_a", "_b"), F.concat("_b", "_a"))
    one = lambda x: F.when(x, 1.0).otherwise(0.0)
    made = F.struct("_p.*", one(c("_mix")).alias("mix_rate"), F.when(c("_union") > 0, F.bround(F.length("_r") / c("_union"), 4)).otherwise(0.0).alias("union_cover"), one(c("dropped")).alias("invent_rate"), one(concat).alias("concat_reject"), c("_delta").alias("verse_delta"), c("_mismatch").alias("pick_mismatch"), c("_score").alias("vote_score"), bucket.alias("review_bucket"))
    return rows.withColumn("vote", made).drop(*[x for x in rows.columns if x.startswith("_")])


def judge_log(rows: DataFrame, keep: str = HAN, clean: bool = True) -> DataFrame:
    """A log row for each judged page.

    rows: image, text_a, text_b, fuse_gt, recommend, pick, source, confidence, retried,
    dropped, boxes_a, boxes_b. Result: image, recommend (accepted and cleaned, or empty),
    gate_ok, judge_flags, vote, and ``metrics``: verses and characters of the three
    texts, whether the recommendation agrees with the fused text, its error rate and bag
    against that (null if that is empty) and both readings, and boxes' confidences (null without one; 0 counts as none).
    """
    c = F.col
    gated = accept_recommendation(c("text_a"), c("text_b"), c("recommend"), keep)
    rows = rows.withColumn("_accepted", gated).withColumn("accepted", clean_main_text(c("_accepted"))["text"] if clean else c("_accepted"))
    rows = vote(rows.drop("_accepted").withColumn("gate_ok", c("accepted") != ""), keep)
    fused = F.coalesce("fuse_gt", F.lit(""))
    has_fused = compact(fused, keep) != ""
    agree = has_fused & (norm(c("accepted"), keep) == norm(fused, keep))
    flags = judge_flags(c("gate_ok"), c("dropped"), c("retried"), F.coalesce("source", F.lit("")), F.coalesce("pick", F.lit("")), agree, fused, c("vote.pick_mismatch"), c("vote.mix_rate") > 0)
    sure = lambda boxes, kind=None: F.filter(F.transform(F.filter(boxes, lambda v: (v["kind"] == kind) if kind else F.lit(True)), lambda v: clamp(v["confidence"])), lambda x: x > 0)
    mean = lambda x: F.when(F.size(x) > 0, F.bround(F.aggregate(x, F.lit(0.0), lambda s, v: s + v) / F.size(x), 4))
    of = {"a": c("boxes_a"), "b": c("boxes_b")}
    metrics = F.struct(
        *[verses(t, keep).alias(f"n_verses_{k}") for k, t in (("a", c("text_a")), ("b", c("text_b")), ("rec", c("accepted")))],
        *[F.length(compact(t, keep)).alias(f"n_chars_{k}") for k, t in (("a", c("text_a")), ("b", c("text_b")), ("rec", c("accepted")))],
        agree.alias("agree_with_fuse"), F.when(has_fused, bag_dice(c("accepted"), fused, keep)).alias("rec_vs_fuse_bag"), F.when(has_fused, cer(fused, c("accepted"), keep)).alias("rec_vs_fuse_cer"),
        *[x for k in ("a", "b") for x in (bag_dice(c("accepted"), c(f"text_{k}"), keep).alias(f"rec_vs_{k}_bag"), cer(c(f"text_{k}"), c("accepted"), keep).alias(f"rec_vs_{k}_cer"))],
        *[x for k, v in of.items() for x in (mean(sure(v)).alias(f"box_conf_{k}_mean"), F.array_min(sure(v)).alias(f"box_conf_{k}_min"), mean(sure(v, "ink_text")).alias(f"ink_conf_{k}_mean"))],
    )
    return rows.select("image", c("accepted").alias("recommend"), "gate_ok", flags.alias("judge_flags"), "vote", metrics.alias("metrics"))
