"""Flushes, stops, logs, chunks of queues, sidecars, overlaps and log rows against small plain models."""

import json
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sievecraft.operators import judging, layout, pages, queues
from sievecraft.sources import logs, tables
from sievecraft.streaming import feed

ROW = "g string, o long, t string"


def test_flush_by_rows_and_by_time(spark, tmp_path):
    write = lambda *rows: spark.createDataFrame(list(rows), ROW).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    write(*[("a", k, None if k == 3 else f"t{k}") for k in range(7)], ("b", 1, "x"), (None, 1, "n"))
    stream = feed.read_feed(spark, f"{tmp_path}/in", spark.createDataFrame([], ROW).schema)

    def work(batch, number):
        batch.write.mode("overwrite").parquet(f"{tmp_path}/out/v={number}")

    got = lambda: spark.read.schema(f"{ROW}, flush int, reason string, size int").parquet(f"{tmp_path}/out").collect()
    query = feed.run_batches(feed.flushed(stream, "g", "o", every=3, seconds=2), work, f"{tmp_path}/checkpoint", seconds=1)
    try:
        end = time.time() + 40
        while time.time() < end:
            time.sleep(1)
            if (tmp_path / "out").exists() and len(got()) == 9:
                break
    finally:
        query.stop()
    rows = got()
    assert sorted((r.o, r.t, r.flush, r.reason, r.size) for r in rows if r.g == "a") == [(k, None if k == 3 else f"t{k}", k // 3 + 1, "rows", 3) for k in range(6)] + [(6, "t6", 3, "time", 1)]
    assert sorted(((r.g, r.flush, r.reason, r.size) for r in rows if r.g != "a"), key=repr) == [("b", 1, "time", 1), (None, 1, "time", 1)]


class _State:
    """A value or a list of a group, which counts the messages that it takes."""

    def __init__(self):
        self.held, self.calls = None, 0

    def _call(self, name):
        self.calls += 1
        return self.held if name == "get" else self.held is not None

    def __getattr__(self, name):
        if name in ("get", "exists"):
            return lambda: self._call(name)
        self.calls += 1
        return lambda *new: setattr(self, "held", new[0] if new else None)


def test_flushes_cost_few_messages_and_no_tables(spark):
    """rows go in and out, and a group without waiting rows asks for its counts only."""
    schema = spark.createDataFrame([], ROW).schema
    flush = feed._Flush(schema, "g", "o", 3, 0)
    flush.state, flush.rows = _State(), _State()
    row = spark.createDataFrame([("a", k, None) for k in (6, 4, 5, 1, 2, 3, 0)], ROW).collect()
    out = list(flush.handleInputRows(("a",), iter(row[:6]), None))
    assert [(r[1], r[3], r[5]) for r in out] == [(1, 1, 3), (2, 1, 3), (3, 1, 3), (4, 2, 3), (5, 2, 3), (6, 2, 3)]
    assert flush.state.calls + flush.rows.calls == 2 and flush.state.held == (2, 0, 0)
    assert list(flush.handleInputRows(("a",), iter(row[6:]), None)) == []
    assert flush.state.held == (2, 0, 1) and [tuple(r) for r in flush.rows.held] == [("a", 0, None)]


def test_a_run_stops_and_goes_on(spark, tmp_path):
    for year in (2020, 2019, 2018, 2017):
        spark.createDataFrame([(year, year)], "id long, year int").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = feed.read_feed(spark, f"{tmp_path}/in", spark.createDataFrame([], "id long, year int").schema, 1)
    told = [F.count("*").alias("taken"), F.lit(0).alias("failed"), F.min("year").alias("oldest_year")]

    def work(batch, number):
        batch.write.mode("overwrite").parquet(f"{tmp_path}/out/v={number}")

    run = lambda bottom: feed.run_until(stream, work, f"{tmp_path}/checkpoint", told, bottom)
    seen = lambda: sorted(r.id for r in spark.read.schema("id long").parquet(f"{tmp_path}/out").collect())
    assert run(2019) == {"batch": 1, "reason": "bottom_year"} and seen() == [2019, 2020]
    # The next run goes on right behind the batch that decided.
    assert run(2018) == {"batch": 2, "reason": "bottom_year"} and seen() == [2018, 2019, 2020]
    assert run(1900) == {"batch": 3, "reason": ""} and seen() == [2017, 2018, 2019, 2020]


def test_a_batch_counts_once(spark, tmp_path):
    path, rows = str(tmp_path), lambda *v: spark.createDataFrame([(str(x),) for x in v], "image string")
    logs.append_log(rows(1, 2), path, "r", 0)
    logs.append_log(rows(3), path, "r", 1)
    logs.append_log(rows(1, 2, 9), path, "r", 0)
    # An attempt that was written but never named.
    rows(7).write.parquet(f"{path}/rows/run=r/batch=2/attempt=lost")
    (tmp_path / "manifest" / "_lost").write_text(json.dumps({"run": "r", "batch": 2, "attempt": "lost"}))
    got = logs.read_log(spark, path, "image string").collect()
    assert sorted((r.run, r.batch, r.image) for r in got) == [("r", 0, "1"), ("r", 0, "2"), ("r", 0, "9"), ("r", 1, "3")]
    with pytest.raises(ValueError):
        logs.append_log(rows(1), path, "a/b", 0)


def test_download_rows(spark):
    given = "post_id string, caption string, urls array<string>, stored array<string>, errors array<string>, at string"
    rows = spark.createDataFrame([("1", "c", ["u"], ["k"], [], ""), ("2", None, [], None, None, ""), ("3", "c", ["u"], ["k"], [f"e{k}" for k in range(9)], ""), ("4", "c", ["u"], [], [], "")], given)
    got = logs.download_rows(rows, "r", 3).collect()
    assert [(r.ok, r.reason, r.files, len(r.errors), r.caption) for r in got] == [(True, None, 1, 0, "c"), (False, "no_cdn_urls", 0, 0, ""), (False, None, 1, 5, "c"), (False, None, 0, 0, "c")]
    assert set(got[0].asDict()) == {f.split(" ")[0] for f in logs.DOWNLOAD_LOG.split(", ")}


def plain_chunk(rows, done, target):
    """One row of each queue in turn, as long as the target is not reached."""
    its = [(s, iter([r for r in rows if r[0] == s])) for s in sorted({r[0] for r in rows})]
    taken, skipped = [], 0
    while its:
        left = []
        for s, it in its:
            if 0 < target <= len(taken):
                return sorted(taken), skipped, 1
            for r in it:
                if r[1] in done:
                    skipped += 1
                    continue
                taken.append(r)
                left.append((s, it))
                break
        its = left
    return sorted(taken), skipped, 0


@pytest.mark.parametrize("target", [0, 1, 2, 7, 13, 40, 1000])
def test_chunk_equals_turns(spark, target):
    rng = random.Random(target)
    for _ in range(2):
        rows = [(s, f"{s}-{k}", k) for s in range(5) for k in range(rng.choice([0, 1, 3, 12]))]
        done = {i for _, i, _ in rows if rng.random() < 0.4}
        if not rows:
            continue
        q = spark.createDataFrame([*rows, (1, " ", 99), (1, None, 98), (None, "x", 1)], "seq int, image string, k int")
        chosen, report = queues.select_chunk(q, spark.createDataFrame([(i,) for i in done] or [("-",)], "image string"), "seq", "image", target, "k")
        want, skipped, full = plain_chunk(rows, done, target)
        r = report.first()
        assert sorted((x.seq, x.image, x.k) for x in chosen.collect()) == want
        assert (r.selected, r.skipped_done, r.target, r.chunk_full) == (len(want), skipped, target, full)


def test_sidecars(spark, tmp_path):
    for name, text in {"a": '{"image": "a", "at": 2}', "b": '{"image": "b"', "c": "\n", "none": "", "d": "[1]", "e": '{"image": null, "at": 1}', "f": '{"image": "a", "at": 3}', "g": "7"}.items():
        (tmp_path / f"{name}.json").write_text(text)
    (tmp_path / "x.txt").write_text("{}")
    rows, counts = tables.scan_sidecars(spark, str(tmp_path), "image string, at int", "image")
    held = spark.createDataFrame([("a", 5), ("z", 1)], "image string, at int")
    after, report = pages.rebuild_counted(rows, counts, held, "image", "at")
    assert sorted((r.image, r.at) for r in after.collect()) == [("a", 5), ("z", 1)]
    assert tuple(report.first()) == (7, 5, 1, 2, 2, 0)


def test_overlaps_of_a_large_page(spark):
    """100,000 boxes on one page, each with itself in the other pass; and all pairs of a small one."""
    side = lambda k, n: (F.col("id") * k % n).cast("int")
    x, y = side(7, 990), (F.col("id") / 990 * 9).cast("int") % 990
    b = F.struct(y.alias("ymin"), x.alias("xmin"), (y + 2).alias("ymax"), (x + 3).alias("xmax"))
    one = spark.range(100_000).select(F.lit(1).alias("page"), b.alias("b"))
    both = one.withColumn("source", F.lit("a")).unionByName(one.withColumn("source", F.lit("b")))
    same = layout.overlaps(both, "page", "source", "b", 0.999)
    copies = one.groupBy("b").count().agg(F.sum(F.col("count") * F.col("count"))).first()[0]
    assert same.count() == copies
    rng = random.Random(2)
    boxes = [(p, s, (y0 := rng.randint(0, 900), x0 := rng.randint(0, 900), y0 + rng.randint(0, 100), x0 + rng.randint(0, 600))) for p in (1, 2) for s in "ab" for _ in range(60)]
    rows = spark.createDataFrame(boxes, "page int, source string, b struct<ymin:int,xmin:int,ymax:int,xmax:int>")

    def iou(p, q):
        i = max(0, min(p[2], q[2]) - max(p[0], q[0])) * max(0, min(p[3], q[3]) - max(p[1], q[1]))
        union = (p[2] - p[0]) * (p[3] - p[1]) + (q[2] - q[0]) * (q[3] - q[1]) - i
        return i / union if union else 0.0

    want = Counter((p, u, v) for p, s, u in boxes for r, t, v in boxes if p == r and (s, t) == ("a", "b") and iou(u, v) >= 0.1)
    assert Counter((r.page, tuple(r.box_a), tuple(r.box_b)) for r in layout.overlaps(rows, "page", "source", "b", 0.1).collect()) == want and want


def test_judge_log(spark):
    box = "array<struct<text:string,kind:string,confidence:double>>"
    schema = f"image string, text_a string, text_b string, fuse_gt string, recommend string, pick string, source string, confidence double, retried boolean, dropped boolean, boxes_a {box}, boxes_b {box}"
    rows = [
        ("mix", "春風又綠", "春雨又緑", "春風又綠", "春雨又綠", "a", "model", 0.9, False, False, [("春", "ink_text", 0.8), ("款", "seal", 0.4), ("x", "ink_text", 0.0)], None),
        ("gone", "春風", "春雨", "", "龍虎", "b", "retry", 0.9, True, True, None, []),
        ("both", "春風", "明月", "春風", "春風明月", "a", "model", 0.9, False, False, None, None),
        ("none", None, None, None, None, None, None, None, False, False, None, None),
    ]
    got = {r.image: r for r in judging.judge_log(spark.createDataFrame(rows, schema)).collect()}
    m = got["mix"]
    assert (m.recommend, m.gate_ok, m.vote.n_disagree, m.vote.n_pick_a, m.vote.n_pick_b, m.vote.mix_rate, m.vote.review_bucket) == ("春雨又綠", True, 2, 1, 1, 1.0, "review_mix")
    assert (m.metrics.agree_with_fuse, m.metrics.rec_vs_fuse_cer, m.metrics.rec_vs_fuse_bag, m.metrics.rec_vs_a_cer) == (False, 0.25, 0.75, 0.25)
    assert (m.metrics.box_conf_a_mean, m.metrics.box_conf_a_min, m.metrics.ink_conf_a_mean, m.metrics.box_conf_b_mean) == (0.6, 0.4, 0.8, None)
    assert m.vote.vote_score == round(0.35 + 0.2 + 0.18 + 0.15 + 0.1, 4) and "glm_mix" in m.judge_flags and "glm_disagree_fuse" in m.judge_flags
    assert (got["gone"].gate_ok, got["gone"].recommend, got["gone"].vote.review_bucket, got["gone"].metrics.rec_vs_fuse_bag) == (False, "", "review_weak", None)
    assert got["both"].vote.concat_reject == 1.0 and not got["both"].gate_ok and got["none"].vote.review_bucket == "review_empty"


def test_posts_of_image_folders(spark, tmp_path):
    for name in ("p1/a.jpg", "p1/b.PNG", "p1/note.txt", "p2/c.webp"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    assert sorted(tuple(r) for r in tables.posts_from_images(spark, str(tmp_path)).collect()) == [("p1", ["a.jpg", "b.PNG"]), ("p2", ["c.webp"])]


def test_a_dataset_is_cleaned_under_its_own_names(spark):
    rows = spark.createDataFrame([(1, "竹❤雨", "[seal]\n款")], "id int, gt string, side string")
    assert tuple(tables.clean_dataset(rows).first()) == (1, "竹雨", "款")
    with pytest.raises(ValueError):
        tables.clean_dataset(rows.select("id"))


def test_sidecars_lie_in_one_folder(spark, tmp_path):
    from pathlib import Path

    from sievecraft.plans import run_queries

    spark.range(1, 40).select(F.col("id").alias("s_suppkey"), F.lit("x").alias("s_name")).write.parquet(f"{tmp_path}/supplier.parquet")
    folder = Path(run_queries._sidecars(spark, str(tmp_path)).removeprefix("file:"))
    assert not [p for p in folder.iterdir() if p.is_dir()] and len(list(folder.glob("*.txt"))) == 39
