"""Reading order of boxes on a page.

A page is an array of boxes, struct<text, ymin, xmin, ymax, xmax, kind, confidence>,
with coordinates from 0 to 1000; pages are small, so an array per page is bounded by
the page. Orders that depend on what came before are folds over the ordered array.
Medians are the upper of the two middle values. Ties keep the earlier box.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import let, strip
from ..functions.pairs import clamp
from ..functions.text import HAN, canonical, compact, script_ratios

BOX = "struct<text:string,ymin:int,xmin:int,ymax:int,xmax:int,kind:string,confidence:double>"
KINDS = {"ink": "ink_text", "ink_text": "ink_text", "main": "ink_text", "handwritten": "ink_text", "margin": "margin", "seal": "seal", "stamp": "seal", "printed": "printed", "print": "printed", "other": "other"}


def box(text: Column, ymin: Column, xmin: Column, ymax: Column, xmax: Column, kind: Column, confidence: Column) -> Column:
    """A box with coordinates as whole numbers from 0 to 1000."""
    side = lambda v, n: F.greatest(F.lit(0), F.least(F.lit(1000), F.coalesce(F.bround(v.cast("double")).cast("int"), F.lit(0)))).alias(n)
    return F.struct(F.coalesce(text, F.lit("")).alias("text"), side(ymin, "ymin"), side(xmin, "xmin"), side(ymax, "ymax"), side(xmax, "xmax"), F.coalesce(kind, F.lit("other")).alias("kind"), clamp(confidence).alias("confidence"))


def polygon_bounds(points: Column, width: Column, height: Column) -> Column:
    """[ymin, xmin, ymax, xmax] from 0 to 1000 of an array of [x, y]; zeros without points or size."""
    scaled = lambda v, n: F.greatest(F.lit(0), F.least(F.lit(1000), F.bround(v * 1000.0 / n).cast("int")))
    xs, ys = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    ok = (F.coalesce(F.size(points), F.lit(0)) > 0) & (width > 0) & (height > 0)
    return F.when(ok, F.array(scaled(F.array_min(ys), height), scaled(F.array_min(xs), width), scaled(F.array_max(ys), height), scaled(F.array_max(xs), width))).otherwise(F.array(*[F.lit(0)] * 4))


def cx(b: Column) -> Column:
    return (b["xmin"] + b["xmax"]) / 2


def cy(b: Column) -> Column:
    return (b["ymin"] + b["ymax"]) / 2


def kind_of(b: Column, keep: str = HAN) -> Column:
    """ink_text, seal, printed or other, by shape, area and script."""
    bare = F.regexp_replace(b["text"], r"(?U)\s+", "")
    w, h = F.greatest(b["xmax"] - b["xmin"], F.lit(1)), F.greatest(b["ymax"] - b["ymin"], F.lit(1))
    r = script_ratios(b["text"], keep)
    tall = (h > w * 1.15) & (r["content"] >= 0.25)
    square = (F.abs(w - h) / F.greatest(w, h) < 0.35) & (w * h < 40_000) & (r["content"] < 0.35)
    foreign = (r["content"] < 0.2) & ((r["latin"] >= 0.4) | (bare == ""))
    return F.when(tall, "ink_text").when(square, "seal").when(foreign, F.when(bare == "", "other").otherwise("printed")).when(r["content"] >= 0.25, "ink_text").otherwise("other")


def normalise(boxes: Column) -> Column:
    """Kinds by alias, no empty texts or areas, in reading order of rows. A seal without text keeps its place."""
    named = F.transform(boxes, lambda b: b.withField("kind", canonical(b["kind"], KINDS, F.lit("other"))).withField("text", F.when((strip(b["text"]) == "") & (F.lower(b["kind"]) == "seal"), "[seal]").otherwise(strip(b["text"]))))
    kept = F.filter(named, lambda b: (b["text"] != "") & (b["ymax"] > b["ymin"]) & (b["xmax"] > b["xmin"]))
    return in_order(kept, lambda b: (b["ymin"], b["xmin"]))


def in_order(boxes: Column, key) -> Column:
    """Boxes sorted by the key's columns, equal keys as they came."""
    keyed = F.transform(boxes, lambda b, i: F.struct(*[k.alias(f"k{n}") for n, k in enumerate(key(b))], i.alias("i"), b.alias("b")))
    return F.transform(F.array_sort(keyed), lambda x: x["b"])


def ltr(boxes: Column) -> Column:
    return in_order(boxes, lambda b: (b["xmin"], b["ymin"]))


def rtl(boxes: Column) -> Column:
    return in_order(boxes, lambda b: (-b["xmax"], b["ymin"]))


def grid(boxes: Column) -> Column:
    return in_order(boxes, lambda b: (b["ymin"], b["xmin"]))


def texts(boxes: Column) -> Column:
    """Lines of the boxes' texts that are not blank."""
    return F.array_join(F.filter(F.transform(boxes, lambda b: strip(b["text"])), lambda t: t != ""), "\n")


def main_boxes(boxes: Column) -> Column:
    return F.filter(boxes, lambda b: b["kind"].isin("ink_text", "main"))


def side_text(boxes: Column) -> Column:
    """Distinct texts of the other boxes, in order."""
    rest = F.filter(boxes, lambda b: ~b["kind"].isin("ink_text", "main") & (strip(b["text"]) != ""))
    return F.array_join(F.array_distinct(F.transform(rest, lambda b: strip(b["text"]))), "\n")


def upper_median(values: Column) -> Column:
    s = F.array_sort(values)
    return F.get(s, F.floor(F.size(s) / 2).cast("int"))


def tiers(boxes: Column, y_gap: float = 120.0) -> Column:
    """One or two arrays of boxes: split at the widest gap between neighbouring centres, if it is wide enough.

    A first of equal gaps counts. Both parts need two boxes, and the page four.
    """

    def split(o: Column) -> Column:
        need = F.greatest(F.lit(float(y_gap)), 1.5 * upper_median(F.transform(o, lambda b: F.greatest(b["ymax"] - b["ymin"], F.lit(1)))))
        gaps = F.transform(F.sequence(F.lit(0), F.size(o) - 2), lambda i: cy(F.get(o, i + 1)) - cy(F.get(o, i)))
        return let(gaps, lambda g: let(F.array_position(g, F.array_max(g)).cast("int"), lambda at: F.when((F.array_max(g) > 0) & (F.array_max(g) >= need) & (at >= 2) & (F.size(o) - at >= 2), F.array(F.slice(o, F.lit(1), at), F.slice(o, at + 1, F.size(o)))).otherwise(F.array(boxes))))

    return F.when(F.size(boxes) < 4, F.array(boxes)).otherwise(let(in_order(boxes, lambda b: (cy(b),)), split))


def columns(boxes: Column) -> Column:
    """Arrays of boxes by column, right to left.

    Boxes from right to left join the first column whose mean centre is near enough;
    near is 0.7 of the upper median width, between 40 and 140.
    """
    near = F.greatest(F.lit(40.0), F.least(F.lit(140.0), 0.7 * upper_median(F.transform(boxes, lambda b: F.greatest(b["xmax"] - b["xmin"], F.lit(1))))))
    # The fold keeps places only; boxes are looked up at its end.
    found_type = "array<struct<total:double,at:array<int>>>"
    state = f"struct<i:int,found:{found_type}>"

    def mean(c: Column) -> Column:
        return c["total"] / F.size(c["at"])

    def place(limit: Column):
        def step(s: Column, x: Column) -> Column:
            at = F.array_position(F.transform(s["found"], lambda c: F.abs(x - mean(c)) <= limit), F.lit(True)).cast("int")
            grown = lambda a: F.transform(s["found"], lambda c, i: F.when(i + 1 == a, F.struct((c["total"] + x).alias("total"), F.concat(c["at"], F.array(s["i"])).alias("at"))).otherwise(c))
            fresh = F.concat(s["found"], F.array(F.struct(x.alias("total"), F.array(s["i"]).alias("at"))))
            return F.struct((s["i"] + 1).alias("i"), let(at, lambda a: F.when(a > 0, grown(a)).otherwise(fresh)).alias("found")).cast(state)

        return step

    def read(o: Column) -> Column:
        start = F.struct(F.lit(0).alias("i"), F.array().cast(found_type).alias("found")).cast(state)
        folded = let(near, lambda limit: F.aggregate(F.transform(o, cx), start, place(limit)))["found"]
        keyed = F.transform(folded, lambda c, i: F.struct((-mean(c)).alias("k"), i.alias("i"), F.transform(c["at"], lambda k: F.get(o, k)).alias("boxes")))
        return F.transform(F.array_sort(keyed), lambda c: c["boxes"])

    return let(in_order(boxes, lambda b: (-cx(b), cy(b))), read)


def glue(host: Column, tail: Column, top_down: bool = False) -> Column:
    """Two boxes as one of ink: texts joined, bounds united, the lower positive confidence."""
    first, second = (F.when(cy(host) <= cy(tail), host).otherwise(tail), F.when(cy(host) <= cy(tail), tail).otherwise(host)) if top_down else (host, tail)
    sure = F.array_min(F.filter(F.array(host["confidence"], tail["confidence"]), lambda c: c > 0))
    return F.struct(
        F.concat(strip(first["text"]), strip(second["text"])).alias("text"),
        *[f(host[c], tail[c]).alias(c) for c, f in (("ymin", F.least), ("xmin", F.least), ("ymax", F.greatest), ("xmax", F.greatest))],
        F.lit("ink_text").alias("kind"),
        F.coalesce(sure, first["confidence"]).alias("confidence"),
    )


def _n(b: Column, keep: str) -> Column:
    return F.length(compact(b["text"], keep))


def join_fragments(column: Column, short: int = 2, keep: str = HAN) -> Column:
    """A column's boxes with fragments joined to their neighbour above; a fragment on top goes after the body below it."""

    def step(out: Column, b: Column) -> Column:
        last = F.get(out, F.size(out) - 1)
        joined = F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(F.when(_n(last, keep) > short, glue(last, b)).otherwise(glue(last, b, True))))
        return F.when((F.size(out) > 0) & let(_n(b, keep), lambda n: (n > 0) & (n <= short)), joined).otherwise(F.concat(out, F.array(b))).cast(f"array<{BOX}>")

    def lead(o: Column) -> Column:
        head, body = F.get(o, F.lit(0)), F.get(o, F.lit(1))
        moved = (F.size(o) >= 2) & (_n(head, keep) > 0) & (_n(head, keep) <= short) & (_n(body, keep) > short)
        return F.when(moved, F.concat(F.array(glue(body, head)), F.slice(o, F.lit(3), F.size(o)))).otherwise(o)

    folded = F.aggregate(in_order(column, lambda b: (cy(b), b["ymin"])), F.array().cast(f"array<{BOX}>"), step)
    return F.when(F.size(column) <= 1, column).otherwise(let(folded, lead))


def join_short_columns(cols: Column, short: int = 2, keep: str = HAN) -> Column:
    """Columns with fragments joined; a column that is one fragment goes to a longer column on its right."""
    size = lambda c: F.aggregate(c, F.lit(0), lambda n, b: n + _n(b, keep))

    def step(out: Column, c: Column) -> Column:
        host = F.get(out, F.size(out) - 1)
        last = F.get(host, F.size(host) - 1)
        tail = F.aggregate(c, last, lambda a, b: glue(a, b).cast(BOX))
        joined = F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(F.concat(F.slice(host, F.lit(1), F.size(host) - 1), F.array(tail))))
        absorb = (F.size(out) > 0) & let(size(c), lambda n: (n > 0) & (n <= short)) & (size(host) > short)
        return F.when(absorb, joined).otherwise(F.concat(out, F.array(c))).cast(f"array<array<{BOX}>>")

    prepared = F.transform(cols, lambda c: join_fragments(c, short, keep))
    return F.aggregate(prepared, F.array().cast(f"array<array<{BOX}>>"), step)


def reading_order(boxes: Column, y_gap: float = 120.0, short: int = 2, keep: str = HAN) -> Column:
    """Ink boxes in order: tiers downwards, in each its columns from the right, fragments joined."""
    items = F.filter(boxes, lambda b: strip(b["text"]) != "")
    ordered = F.flatten(F.flatten(F.transform(tiers(items, y_gap), lambda t: join_short_columns(columns(t), short, keep))))
    return F.when(F.size(items) == 0, items).otherwise(ordered)


def reassemble(boxes: Column, ordered_ink: Column) -> Column:
    """Ordered ink, then the other boxes as they were."""
    rest = F.filter(boxes, lambda b: ~F.replace(F.lower(strip(b["kind"])), F.lit("-"), F.lit("_")).isin("ink_text", "main"))
    return F.concat(ordered_ink, rest)


def column_lines(boxes: Column) -> Column:
    """One line of text per column, right to left."""
    items = F.filter(boxes, lambda b: strip(b["text"]) != "")
    joined = F.transform(columns(items), lambda c: F.array_join(F.transform(in_order(c, lambda b: (cy(b), b["ymin"])), lambda b: strip(b["text"])), ""))
    return F.when(F.size(items) == 0, F.array().cast("array<string>")).otherwise(F.filter(joined, lambda t: t != ""))


def is_per_character(boxes: Column, keep: str = HAN) -> Column:
    """Four boxes or more with content, of which the upper median has one character."""
    sizes = F.filter(F.transform(boxes, lambda b: _n(b, keep)), lambda n: n > 0)
    return (F.size(sizes) >= 4) & (upper_median(sizes) <= 1)


def weighted_confidence(boxes: Column, keep: str = HAN) -> Column:
    """Mean confidence by number of content characters; 0 without any."""
    total = F.aggregate(boxes, F.lit(0.0), lambda a, b: a + clamp(b["confidence"]) * _n(b, keep))
    return let(F.aggregate(boxes, F.lit(0), lambda a, b: a + _n(b, keep)), lambda n: F.when(n > 0, clamp(F.round(total / n, 10))).otherwise(0.0))


def iou(a: Column, b: Column) -> Column:
    """Area that two boxes share over the area of both."""
    w = F.greatest(F.lit(0), F.least(a["xmax"], b["xmax"]) - F.greatest(a["xmin"], b["xmin"]))
    h = F.greatest(F.lit(0), F.least(a["ymax"], b["ymax"]) - F.greatest(a["ymin"], b["ymin"]))
    area = lambda x: (x["xmax"] - x["xmin"]) * (x["ymax"] - x["ymin"])
    union = area(a) + area(b) - w * h
    return F.when(meet(a, b) & (union > 0), w * h / union).otherwise(0.0)


def meet(a: Column, b: Column) -> Column:
    """Whether two boxes share any area: a test that most pairs fail at once."""
    return (a["xmin"] < b["xmax"]) & (b["xmin"] < a["xmax"]) & (a["ymin"] < b["ymax"]) & (b["ymin"] < a["ymax"])


#: Side of a grid cell in which boxes of two passes meet: a usual box lies in one or two.
CELL = 128


def overlaps(boxes: DataFrame, page: str, source: str, b: str, at_least: float = 0.25) -> DataFrame:
    """(page, box_a, box_b, iou): pairs of a page's boxes from two passes (source 'a' and 'b') that overlap enough.

    Boxes meet in the cells of a grid that they cover, so a page's boxes are compared
    with those near them only, in as many tasks as it has cells. A pair is reported by
    one cell, that of its common part's upper left corner.
    """
    if at_least <= 0:
        raise ValueError("boxes that do not overlap meet in no cell: at_least must be above 0")

    def cells(s: str, name: str) -> DataFrame:
        x = F.col(b)
        line = lambda low, high: F.sequence(F.floor(x[low] / CELL).cast("int"), F.floor(F.greatest(x[low], x[high] - 1) / CELL).cast("int"))
        rows = boxes.where((F.col(source) == s) & x.isNotNull()).select(page, x.alias(name), line("xmin", "xmax").alias("cx"), line("ymin", "ymax").alias("cy"))
        return rows.select(page, name, F.explode("cx").alias("cx"), "cy").select(page, name, "cx", F.explode("cy").alias("cy"))

    first = lambda side: F.floor(F.greatest(F.col("box_a")[side], F.col("box_b")[side]) / CELL)
    met = cells("a", "box_a").join(cells("b", "box_b"), [page, "cx", "cy"]).where((F.col("cx") == first("xmin")) & (F.col("cy") == first("ymin")))
    return met.withColumn("iou", iou(F.col("box_a"), F.col("box_b"))).where(F.col("iou") >= at_least).drop("cx", "cy")


def pick_pass(a: Column, b: Column, keep: str = HAN) -> Column:
    """a or b, for one place read twice: by script, then by confidence. b may be null."""
    return let(F.struct(script_ratios(a["text"], keep).alias("a"), script_ratios(b["text"], keep).alias("b")), lambda r: _picked(a, b, r["a"], r["b"]))


def _picked(a: Column, b: Column, ra: Column, rb: Column) -> Column:
    ca, cb = a["confidence"], b["confidence"]
    first = F.struct(a.alias("box"), F.lit("a").alias("source"))
    second = F.struct(b.alias("box"), F.lit("b").alias("source"))
    content = (ra["content"] >= 0.35) & (ra["content"] >= ra["latin"]) & (ra["content"] >= rb["content"])
    latin = ((rb["latin"] >= 0.35) | ((ra["latin"] >= 0.35) & (rb["latin"] >= ra["latin"]))) & (cb >= ca * 0.85)
    surer = (cb > ca * 1.1) & (rb["latin"] >= ra["latin"])
    return F.when(b.isNull() | content, first).when(latin | surer, second).when(ca >= cb, first).otherwise(second)


def merge_passes(a: Column, b: Column, at_least: float = 0.25, keep: str = HAN) -> Column:
    """Boxes of two passes over a page as one array of struct (box, source), top to bottom.

    Each box of a, in order, takes the unused box of b that overlaps it most; what is
    left of b stays if it overlaps no box of a enough.
    """
    state = f"struct<used:array<int>,out:array<struct<box:{BOX},source:string>>>"

    def step(s: Column, x: Column) -> Column:
        scores = F.transform(b, lambda y, j: F.when(meet(x, y) & ~F.array_contains(s["used"], j), iou(x, y)).otherwise(0.0))

        def chosen(v: Column) -> Column:
            at = F.array_position(v, F.array_max(v)).cast("int") - 1
            hit = (F.size(v) > 0) & (F.array_max(v) >= at_least) & (F.array_max(v) > 0)
            used = F.when(hit, F.concat(s["used"], F.array(at))).otherwise(s["used"])
            return F.struct(used.alias("used"), F.concat(s["out"], F.array(pick_pass(x, F.when(hit, F.get(b, at)), keep))).alias("out")).cast(state)

        return let(scores, chosen)

    start = F.struct(F.array().cast("array<int>").alias("used"), F.array().cast(f"array<struct<box:{BOX},source:string>>").alias("out"))

    def finish(s: Column) -> Column:
        free = F.filter(b, lambda y, j: ~F.array_contains(s["used"], j) & ~F.exists(a, lambda x: iou(y, x) >= at_least))
        every = F.concat(s["out"], F.transform(free, lambda y: F.struct(y.alias("box"), F.lit("b").alias("source"))))
        keyed = F.transform(every, lambda x, i: F.struct(x["box"]["ymin"].alias("y"), x["box"]["xmin"].alias("x"), i.alias("i"), x.alias("b")))
        return F.transform(F.array_sort(keyed), lambda x: x["b"])

    return F.aggregate(a, start.cast(state), step, finish)


def _grouped(boxes: Column, at, near: Column, key) -> Column:
    """Boxes in order of the key, in arrays: one joins the last array if its place is near the mean of that array's places."""
    # The fold keeps where each array starts and its size; boxes are cut at its end.
    state = "array<struct<total:double,start:int,n:int>>"

    def step(rows: Column, x: Column) -> Column:
        last = F.get(rows, F.size(rows) - 1)
        joins = (F.size(rows) > 0) & (F.abs(x - last["total"] / last["n"]) <= near)
        grown = F.struct((last["total"] + x).alias("total"), last["start"].alias("start"), (last["n"] + 1).alias("n"))
        fresh = F.struct(x.alias("total"), F.coalesce(last["start"] + last["n"], F.lit(0)).alias("start"), F.lit(1).alias("n"))
        return F.when(joins, F.concat(F.slice(rows, F.lit(1), F.size(rows) - 1), F.array(grown))).otherwise(F.concat(rows, F.array(fresh))).cast(state)

    cut = lambda o: F.transform(F.aggregate(F.transform(o, at), F.array().cast(state), step), lambda r: F.struct(r["total"].alias("total"), F.slice(o, r["start"] + 1, r["n"]).alias("boxes")))
    return let(in_order(boxes, key), cut)


def placed_rows(boxes: Column) -> Column:
    """Array of (y, text): horizontal lines. Boxes whose centres lie within 0.6 of the median height, 4 at least, share one.

    In a line boxes go left to right, with a blank where the gap is over 0.35 of the height of the box before.
    """
    tall = lambda b: F.greatest(b["ymax"] - b["ymin"], F.lit(1))

    def line(bs: Column) -> Column:
        def word(b: Column, i: Column) -> Column:
            before = F.get(bs, i - 1)
            return F.concat(F.when((i > 0) & (b["xmin"] - before["xmax"] > 0.35 * tall(before)), " ").otherwise(""), strip(b["text"]))

        return F.array_join(F.transform(bs, word), "")

    def read(h: Column) -> Column:
        rows = _grouped(boxes, cy, F.greatest(0.6 * h, F.lit(4.0)), lambda b: (cy(b), b["xmin"]))
        return F.transform(rows, lambda r: F.struct((r["total"] / F.size(r["boxes"])).alias("y"), let(in_order(r["boxes"], lambda b: (b["xmin"],)), line).alias("text")))

    return F.when(F.size(boxes) == 0, F.array().cast("array<struct<y:double,text:string>>")).otherwise(let(upper_median(F.transform(boxes, tall)), read))


def text_rows(boxes: Column) -> Column:
    """The texts of the horizontal lines."""
    return F.transform(placed_rows(boxes), lambda r: r["text"])


def placed_columns(boxes: Column) -> Column:
    """Array of (y, text): vertical boxes by column from the left, each from its top. Centres within 0.75 of the median width, 24 at least, share a column."""
    wide = lambda b: F.greatest(b["xmax"] - b["xmin"], F.lit(1))

    def read(w: Column) -> Column:
        found = _grouped(boxes, cx, F.greatest(0.75 * w, F.lit(24.0)), lambda b: (cx(b), b["ymin"]))
        return F.flatten(F.transform(found, lambda r: F.transform(in_order(r["boxes"], lambda b: (b["ymin"],)), lambda b: F.struct(cy(b).alias("y"), strip(b["text"]).alias("text")))))

    return F.when(F.size(boxes) == 0, F.array().cast("array<struct<y:double,text:string>>")).otherwise(let(upper_median(F.transform(boxes, wide)), read))


def page_text(boxes: Column, keep: str = HAN) -> Column:
    """A page's text: horizontal lines and vertical boxes (over 1.4 times as high as wide, two fifths of them content script) from the top down.

    Boxes without text are left out; of equal heights lines come first, then columns from the left.
    """

    def is_vertical(b: Column) -> Column:
        return (F.greatest(b["ymax"] - b["ymin"], F.lit(1)) > F.greatest(b["xmax"] - b["xmin"], F.lit(1)) * 1.4) & (script_ratios(b["text"], keep)["content"] >= 0.4)

    def read(bs: Column) -> Column:
        every = F.concat(placed_rows(F.filter(bs, lambda b: ~is_vertical(b))), placed_columns(F.filter(bs, is_vertical)))
        keyed = F.transform(every, lambda r, i: F.struct(r["y"].alias("y"), i.alias("i"), r["text"].alias("text")))
        return F.array_join(F.filter(F.transform(F.array_sort(keyed), lambda r: r["text"]), lambda t: strip(t) != ""), "\n")

    return let(F.filter(boxes, lambda b: strip(b["text"]) != ""), read)
