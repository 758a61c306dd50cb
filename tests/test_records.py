"""Validity, merges, queues, roll-ups and fusion."""

import pytest
from pyspark.sql import functions as F

from sievecraft.functions.base import blank, strip
from sievecraft.functions.text import normalise_label
from sievecraft.operators import fuse, queues, records, rollup
from sievecraft.plans import catalogue, record_queries
from sievecraft.sources import tables
from sievecraft.streaming import feed


def test_validity(one):
    c = records.classify(F.col("a"), F.col("b"))
    images = F.array(F.lit("x"))
    for text, want in (("", "missing_label"), ("Like", "ui_noise_caption"), ("see more of it", "ui_noise_caption"), ("xyz", "not_content_caption"), ("春風", None), ("Some real words of text here", None)):
        assert one(records.classify(F.lit(text), images))["reason"] == want
    assert one(c, a="", b=[])["reason"] == "missing_label_and_image" and one(c, a="春風", b=[])["reason"] == "missing_image"


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1, 0), ("b", 2, 0)], "image string, v int, o int")
    new = spark.createDataFrame([("b", 3, 1), ("b", 4, 2), ("c", 5, 1), ("", 6, 1)], old.schema)
    once = records.upsert(old, new, "image", "o")
    twice = records.upsert(once, new, "image", "o")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [("a", 1, 0), ("b", 4, 2), ("c", 5, 1)]


def test_merge_keeps_valid_and_filled(spark):
    rows = spark.createDataFrame([("p", 1, "x", ["u"], "valid", True), ("p", 2, "", ["u", "v"], "invalid", False), ("p", 3, None, None, "pending", False)], "k string, o int, t string, l array<string>, s string, is_valid boolean")
    got = records.merge_fields(rows, "k", "o", ["t"], ["l"], "s").first()
    assert (got.t, got.l, got.s, got.is_valid) == ("x", ["u", "v"], "valid", True)


def test_merge_of_reasons_images_and_tiles(spark):
    schema = "k string, o int, is_valid boolean, invalid_reason string, images array<string>, story string, tiles array<string>"
    rows = spark.createDataFrame([("p", 1, False, "missing_image", ["u?a=1"], None, ["t1", "s"]), ("p", 2, True, None, ["u?b=2", "v"], "s", ["t2"]), ("p", 3, False, "ui_noise_caption", ["w.mp4"], "", None), ("q", 1, True, "odd", [], None, []), ("q", 2, False, "late", None, None, None), ("r", 1, False, "one", [], None, []), ("r", 2, False, "two", [], None, [])], schema)
    got = {r.k: r for r in records.merge_fields(rows, "k", "o", ["story"], ["tiles"], images=["images"], without={"tiles": "story"}).collect()}
    assert (got["p"].is_valid, got["p"].invalid_reason, got["p"].images, got["p"].tiles) == (True, "missing_image", ["u?a=1", "v"], ["t1", "t2"])
    assert got["q"].invalid_reason == "odd" and got["r"].invalid_reason == "two"


def test_two_sided_upsert(spark):
    v = spark.createDataFrame([("10", "a"), ("9", "b"), ("x", "c")], "post_id string, t string")
    i = spark.createDataFrame([("7", "d")], "post_id string, t string")
    new = spark.createDataFrame([("10", "e", False, 1), ("7", "f", False, 1), ("7", "g", True, 2), ("100", "h", None, 3)], "post_id string, t string, is_valid boolean, o int")
    got = [(r.post_id, r.t, r.is_valid) for r in records.upsert_two_sided(v, i, new, "post_id", "o").collect()]
    assert got == [("x", "c", True), ("7", "g", True), ("9", "b", True), ("10", "e", False), ("100", "h", False)]


def test_last_row_of_a_source_counts(spark):
    u = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    fused = spark.createDataFrame([(1, "zz", "old", 1), (1, "aa", "new", 2), (3, " ", "x", 1)], "k int, ground_truth string, note string, o int")
    legacy = spark.createDataFrame([(1, "aa", "l1", 1), (3, "cc", "l3", 1)], fused.schema)
    got = {r.k: (r.gt_source, r.ground_truth, r.note) for r in records.merge_sources(u, fused, legacy, "k", F.lit(1.0), order="o", side=("note",)).collect()}
    assert got == {1: ("fuse", "aa", "new"), 2: ("pending", "", None), 3: ("legacy_ocr", "cc", "l3")}
    known = spark.createDataFrame([(1, "zz", 1), (1, "aa", 2)], "k int, label string, o int")
    assert [r.label for r in records.backfill(u.withColumn("label", F.lit("")), known, "k", "label", "o").orderBy("k").collect()] == ["aa", "", ""]


def test_complete_rows_and_blank_texts(spark, one):
    schema = "post_id string, permalink string, caption string, image_urls array<string>, cdn_urls array<string>, valid boolean, author_hint string"
    rows = spark.createDataFrame([("1", "l", " c ", ["u?a", "u?b", "v.mp4"], None, True, "h"), ("2", None, "c", [], ["w"], True, None), ("3", "l", "", ["u"], None, True, None), ("4", "l", "c", ["v.mp4"], None, True, None), ("5", "l", "c", ["u"], None, False, None)], schema)
    got = {r.post_id: (r.caption, r.image_urls, r.author, r.permalink, r.batch_seq, r.valid) for r in records.pass_through(rows, 7, "run").collect()}
    assert got == {"1": ("c", ["u?a"], "h", "l", 7, True), "2": ("c", ["w"], "", "", 7, True)}
    empty = lambda gt, *boxes: one(records.text_empty(F.lit(gt), F.array(*map(F.lit, boxes))))
    assert empty(" \n") and empty("", "", " ") and not empty("x") and not empty("", "y")
    assert one(records.is_noise(F.lit("其他都不准貼文 今天寫了很多很好看的字請大家來看看這一張作品吧再多寫一些字讓這個標題超過六十四個字元的長度限制好了還有更多更多的字在後面")))
    inside = lambda seq, unknown: one(records.in_window(F.lit(seq).cast("int"), 2, 4, unknown))
    assert [inside(x, False) for x in (None, 0, 1, 2, 4, 5)] == [False, False, False, True, True, False] and inside(None, True) and inside(0, True)


def test_images_and_windows(one):
    assert one(records.distinct_images(F.array(*map(F.lit, ("u?a=1", "u?b=2", "v", "w.mp4"))))) == ["u?a=1", "v"]
    assert records.retry_window(5) == (1, 5, True) and records.retry_window(5, backfilled=True) == (5, 5, False)
    with pytest.raises(ValueError):
        records.merge_sources(None, None, None, "k", None, prefer="other")


@pytest.mark.parametrize("n, sizes", [(14, [1] * 10 + [2, 2]), (3, [1, 1, 1])])
def test_split(spark, n, sizes):
    got = queues.contiguous_split(spark.range(n), 12, "id").groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in got] == sizes and (n > 12 or [r.batch for r in got] == [9, 10, 11])


def test_p95(spark):
    rows = spark.range(1, 21).select(F.col("id").cast("int").alias("ms"), F.array().cast("array<string>").alias("f"))
    got = rollup.judge_summary(rows, "f", {}, {}, {}, "ms").first()
    assert (got.n, got.p50_latency_ms, got.p95_latency_ms) == (20, 10, 19)


def test_alignment_uses_each_line_once(spark):
    pages = spark.createDataFrame([("p", ["春風又綠江南岸", "明月何時照我還", "甲"], ["明月何时照我还", "春風又綠江南岸"]), ("q", ["一"], [])], "image string, a array<string>, b array<string>")
    got = {(r.image, r.line_id): (r.text_b, r.status) for r in fuse.align(pages, "image", "a", "b").collect()}
    assert got[("p", "0")] == ("春風又綠江南岸", "match") and got[("p", "1")][0] == "明月何时照我还" and got[("p", "2")] == ("", "a_only") and got[("q", "0")] == ("", "a_only")
    lines = fuse.fuse(fuse.align(pages, "image", "a", "b"), F.lit("")).where("image = 'p' and line_id = '1'").first()
    assert (lines.fuse, lines.line) == ("hitl_glyph", "明月何時照我還") or (lines.fuse, lines.status) == ("equal_s2t", "match")


def test_gates(one):
    for args, want in (((0.08, 92.0, 0.5, 0.0, 0.85), "match"), ((0.09, 0.0, 0.92, 0.0, 1.0), "order_fix"), ((0.5, 0.0, 0.5, 90.0, 0.69), "partial"), ((0.21, 0.0, 0.79, 0.0, 1.0), "glyph_mismatch"), ((0.2, 0.0, 0.79, 0.0, 1.0), "weak")):
        assert one(fuse.gate(*map(F.lit, args))) == want
    assert one(fuse.vote_score(F.lit(True), F.lit("model"), F.lit(1.0), F.lit(False), F.lit(False))) == 1.0
    cut = fuse.cut_by_template(F.lit("abcdef"), F.array(F.lit("xx"), F.lit("y")))
    assert one(cut) == ["ab", "cdef"]


def test_json_sources(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": 1}\n\n# note\nnot json\n[1]\n{"k": 2}\n')
    rows, rejects = tables.read_jsonl_strict(spark, str(tmp_path / "a.jsonl"), "k int")
    assert sorted(r.k for r in rows.collect()) == [1, 2] and rejects.count() == 2
    with pytest.raises(ValueError):
        tables.require_no_rejects(rows, rejects)
    paths = spark.createDataFrame([("file:/x/7/b.jpg",), ("file:/x/7/a.png",), ("file:/x/8/n.txt",)], "path string")
    assert [tuple(r) for r in tables.posts_from_paths(paths).collect()] == [("7", ["a.png", "b.jpg"])]


def test_retries(spark):
    k = lambda *x: spark.createDataFrame([(v,) for v in x], "k int")
    a = spark.createDataFrame([(1, 2), (2, 2), (3, 0)], "k int, attempts int")
    got = {r.k: (r.attempts, r.exhausted) for r in feed.retry(k(1, 2, 4), a, k(2), "k", 3).collect()}
    assert got == {1: (3, True), 2: (3, False), 3: (0, False), 4: (1, False)}


def test_merge_scores_whole_texts(spark, tmp_path):
    rows = [(3, " " * 40 + "late text"), (6, "x" * 250 + "e" * 300), (7, "plain"), (9, "xyz" * 100), (12, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    run = lambda name: catalogue.QUERIES[name](spark, str(tmp_path)).collect()
    assert {r.doc_id: r.gt_source for r in run("j6_merge_sources")} == {3: "legacy_ocr", 6: "fuse", 7: "pending", 9: "legacy_ocr", 12: "pending"}
    assert {r.doc_id: (r.bag_fuse_vs_legacy, r.diverge_flag) for r in run("j6_merged_bag")} == {3: (0.4, True), 6: (0.625, True), 7: (1.0, False), 9: (1.0, False), 12: (None, False)}
    assert {r.gt_source: (r.n, r.n_diverge) for r in run("a6_merged_bag_summary")} == {"fuse": (4, 2), "pending": (1, 0)}


def test_summary_counts_the_flag_of_the_merge(spark, monkeypatch):
    one = spark.createDataFrame([("fuse", True), ("fuse", False)], "gt_source string, diverge_flag boolean")
    monkeypatch.setattr(record_queries, "_merged", lambda *_: one)
    assert [(r.n, r.n_diverge) for r in record_queries.a6_merge_summary(spark, "").collect()] == [(2, 1)]


def test_json_is_walked_to_its_end(spark):
    deep = '{"a":' * 70 + '{"post_id": "7", "message": "m"}' + "}" * 70
    rows = spark.createDataFrame([(1, deep)], "k int, doc string")
    assert [tuple(r) for r in tables.feed_candidates(rows, "k", "doc").collect()] == [(1, "7", "m", None)]


def test_noise_inside_a_text_is_found_by_its_words(spark):
    long = "some text that goes on for more than sixty-four letters, and on, "
    noise = ["what's posted in the group", "whatſ poſted in group", "visible to all group members", "12 lıkes", "ANYONE CAN SEE who's in", "chỉ thành viên nhóm mới xem"]
    rows = spark.createDataFrame([(i, long + t) for i, t in enumerate([*noise, "nothing of it", "likely visible"])], "i int, t string")
    old = "(?iU)" + "|".join(f"(?:{p})" for p in records.NOISE_PATTERNS)
    got = rows.select("i", records.is_noise(F.col("t")).alias("is"), F.lower("t").rlike(old).alias("was")).orderBy("i").collect()
    assert [r["is"] for r in got] == [r["was"] for r in got] and [r["is"] for r in got][-2:] == [False, False]


def test_validity_is_settled_by_the_first_words(spark):
    """blanks, words and noise words as before; the rules that read a whole text stand behind the one that ends early."""
    blanks = ["", " ", "\u3000\n", "\t a\u2003b \r\n", "a\x85", "\u200b", "\ufeffa ", None, "x\r\n", "a  b\n\nc \t d"]
    words = ["word and then nothing.", "word_word 1234567", "wordword 12345678", "  word, more  \n12345", "đ 123456789012345678901", "12345678901234567890"]
    rows = spark.createDataFrame([(t,) for t in blanks + words], "t string")
    t = F.col("t")
    was = F.regexp_replace(F.coalesce(t, F.lit("")), r"(?U)^\s+|\s+$", "")
    count = (F.length(t) >= 16) & (F.regexp_count(t, F.lit("[A-Za-z]{4,}")) >= 2)
    assert rows.where(strip(t) != was).count() == 0 and rows.where(blank(t) != (was == "")).count() == 0
    assert rows.where(normalise_label(t) != F.regexp_replace(F.lower(was), r"(?U)\s+", " ")).count() == 0
    assert rows.where(count & ~records._written(t)).count() == 0
    rule = str(records._written(t)).lower()
    assert rule.index("split") < rule.index("rlike")
