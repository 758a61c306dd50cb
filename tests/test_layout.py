"""Reading order on tiny pages."""

from pyspark.sql import functions as F

from sievecraft.operators import layout as y


def page(spark, *boxes):
    rows = [(t, *b, k, 0.9) for t, b, k in ((x + ("ink_text",))[:3] for x in boxes)]
    return spark.createDataFrame([(rows,)], f"boxes array<{y.BOX}>")


def order(spark, *boxes, **kw):
    return page(spark, *boxes).select(F.transform(y.reading_order(F.col("boxes"), **kw), lambda b: b["text"]).alias("t")).first()["t"]


def test_columns_right_to_left(spark):
    assert order(spark, ("左柱", (10, 100, 200, 160)), ("中柱", (10, 400, 200, 460)), ("右柱", (10, 700, 200, 760))) == ["右柱", "中柱", "左柱"]


def test_fragments_join(spark):
    assert order(spark, ("飽秉燭相尋語", (50, 100, 800, 160)), ("夜深", (50, 100, 200, 150))) == ["飽秉燭相尋語夜深"]
    body = "一二三四五六七八九十甲乙丙丁"
    assert order(spark, (body, (100, 200, 900, 280)), ("增", (100, 80, 200, 140))) == [body + "增"]
    assert order(spark, ("神茶", (50, 700, 200, 780)), ("蘭壘", (50, 200, 200, 280))) == ["神茶", "蘭壘"]


def test_two_tiers(spark):
    got = order(spark, ("下右", (700, 700, 900, 780)), ("下左", (700, 200, 900, 280)), ("上左", (100, 200, 300, 280)), ("上右", (100, 700, 300, 780)), y_gap=80)
    assert got == ["上右", "上左", "下右", "下左"]


def test_ink_first(spark):
    p = page(spark, ("落款", (0, 0, 9, 9), "margin"), ("正文", (10, 10, 99, 99)))
    got = p.select(y.reassemble(F.col("boxes"), y.reading_order(y.main_boxes(F.col("boxes")))).alias("b"), y.side_text(F.col("boxes")).alias("s")).first()
    assert [b.text for b in got.b] == ["正文", "落款"] and got.s == "落款"


def test_two_passes(spark):
    p = page(spark, ("春風", (0, 0, 100, 100)), ("abc", (0, 5, 100, 105)), ("far", (500, 500, 600, 600)))
    got = p.select(y.merge_passes(F.slice("boxes", F.lit(1), 1), F.slice("boxes", 2, 2)).alias("m")).first()["m"]
    assert [(x.box.text, x.source) for x in got] == [("春風", "a"), ("far", "b")]


def test_rows_of_text(spark):
    p = page(spark, ("b", (0, 50, 20, 60)), ("a", (2, 0, 22, 10)), ("c", (100, 0, 120, 10)))
    assert p.select(y.text_rows(F.col("boxes")).alias("r")).first()["r"] == ["a b", "c"]


def test_empty_page(spark):
    p = page(spark).select(y.reading_order(F.col("boxes")).alias("o"), y.column_lines(F.col("boxes")).alias("l"), y.weighted_confidence(F.col("boxes")).alias("c"))
    assert tuple(p.first()) == ([], [], 0.0)


def plain_page_text(boxes):
    """Lines and columns of boxes as lists, for comparison."""
    tall = [b for b in boxes if b["ymax"] - b["ymin"] > 1.4 * (b["xmax"] - b["xmin"])]
    wide = [b for b in boxes if b not in tall]
    mid = lambda b, a: (b[a + "min"] + b[a + "max"]) / 2

    def grouped(bs, axis, near, other):
        out = []
        for b in sorted(bs, key=lambda b: (mid(b, axis), b[other])):
            if out and abs(mid(b, axis) - sum(mid(x, axis) for x in out[-1]) / len(out[-1])) <= near:
                out[-1].append(b)
            else:
                out.append([b])
        return out

    median = lambda v: sorted(v)[len(v) // 2]
    placed = []
    if wide:
        for row in grouped(wide, "y", max(0.6 * median([b["ymax"] - b["ymin"] for b in wide]), 4), "xmin"):
            row.sort(key=lambda b: b["xmin"])
            text = row[0]["text"]
            for p, b in zip(row, row[1:], strict=False):
                text += (" " if b["xmin"] - p["xmax"] > 0.35 * (p["ymax"] - p["ymin"]) else "") + b["text"]
            placed.append((sum(mid(b, "y") for b in row) / len(row), text))
    if tall:
        for column in grouped(tall, "x", max(0.75 * median([b["xmax"] - b["xmin"] for b in tall]), 24), "ymin"):
            placed += [(mid(b, "y"), b["text"]) for b in sorted(column, key=lambda b: b["ymin"])]
    return "\n".join(t for _, t in sorted(placed, key=lambda p: p[0]))


def test_page_text_equals_a_plain_version(spark):
    import random

    rng = random.Random(2)
    rows = []
    for k in range(60):
        boxes = []
        for i in range(rng.randint(1, 12)):
            top, left = rng.randint(0, 800), rng.randint(0, 800)
            boxes.append({"text": f"春{i}風", "ymin": top, "xmin": left, "ymax": top + rng.choice((10, 20, 40, 200)), "xmax": left + rng.choice((15, 30, 120)), "kind": "ink_text", "confidence": 1.0})
        rows.append((k, boxes))
    df = spark.createDataFrame(rows, f"k int, boxes array<{y.BOX}>")
    for r in df.select("boxes", y.page_text(F.col("boxes")).alias("t")).collect():
        assert r.t == plain_page_text([b.asDict() for b in r.boxes])
