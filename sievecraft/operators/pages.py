"""Operators over page tables: reviews, comparisons, recommendations and their logs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from ..functions.base import blank, let, lines, non_empty, strip
from ..functions.pairs import bag_dice, cer, has_invented, has_invented_count
from ..functions.text import HAN, compact, norm, to_traditional
from ..sources.scratch import save
from .alignment import Index
from .fuse import cut_by_template
from .records import classify, distinct_images, newest


def slim(rows: DataFrame, caption: str, images: str, longest: int = 500, most: int = 12) -> DataFrame:
    """rows with captions cut and no more than the first images."""
    return rows.withColumn(caption, F.substring(caption, 1, longest)).withColumn(images, F.slice(images, 1, most))


def needs_refetch(complete: Column, reason: Column) -> Column:
    """Rows to fetch again: incomplete, or something is missing."""
    return ~F.coalesce(complete, F.lit(False)) | F.coalesce(reason.isin("missing_caption", "missing_image", "missing_caption_and_image"), F.lit(False))


def review_rows(pages: DataFrame, judged: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Pages that were judged, with the judgement and the label if there is one."""
    return pages.join(judged, key).join(labels, key, "left")


def attach_results(rows: DataFrame, results: DataFrame, key: str, columns: tuple[str, ...]) -> DataFrame:
    """rows with the results' columns where a result came, else their own."""
    named = results.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    out = rows.join(named, key, "left")
    return out.withColumns({c: F.coalesce(f"_new_{c}", c) for c in columns}).drop(*[f"_new_{c}" for c in columns])


def posts_of_tiles(posts: DataFrame, tiles: DataFrame, post: str, tile_ids: str, tile: str) -> DataFrame:
    """(post, tile): tiles that a post lists."""
    return posts.select(post, F.explode(tile_ids).alias(tile)).distinct().join(tiles.select(tile).distinct(), tile, "left_semi")


def span_reason(spans: Column, a: Column, b: Column) -> Column:
    """The reason of the first span with these two texts; empty if there is none."""
    return F.coalesce(F.get(F.filter(spans, lambda s: (s["a"] == a) & (s["b"] == b)), F.lit(0))["reason"], F.lit(""))


def rebuild(sidecars: DataFrame, table: DataFrame, key: str, at: str) -> DataFrame:
    """A table from its sidecars and what it held: the newer row of each key; the sidecar of equal ones."""
    return newest(key, at, table, sidecars.select(*table.columns))


def rebuild_counted(sidecars: DataFrame, counts: DataFrame, table: DataFrame, key: str, at: str) -> tuple[DataFrame, DataFrame]:
    """(table, report): ``rebuild`` of a scan of sidecars and its counts (files, unreadable).

    report: one row of files, unreadable, records (distinct keys of readable sidecars),
    before, after, and recovered: by how much the table has grown.
    """
    after = save(rebuild(sidecars, table, key, at), "rebuilt")
    n = lambda df, name: df.agg(F.count_distinct(key).alias(name))
    one = counts.select(F.struct("*").alias("c")).withColumns({c: n(df, c).scalar() for c, df in (("records", sidecars), ("before", table), ("after", after))})
    return after, one.select("c.files", "c.unreadable", "records", "before", "after", F.greatest(F.col("after") - F.col("before"), F.lit(0)).alias("recovered"))


def prior_fill(rows: DataFrame, prior: DataFrame, key: str) -> DataFrame:
    """rows with a blank caption taken from the prior record, images of both, classified again.

    ``counts``: whether the row is newly valid.
    """
    p = prior.select(key, F.col("caption").alias("_caption"), F.col("image_urls").alias("_images"), F.col("valid").alias("_valid"))
    none = F.array().cast("array<string>")
    out = rows.join(p, key, "left").withColumn("caption", F.coalesce(non_empty(F.col("caption")), F.col("_caption")))
    out = out.withColumn("image_urls", distinct_images(F.concat(F.coalesce("_images", none), F.coalesce("image_urls", none)))).withColumn("_c", classify(F.col("caption"), F.col("image_urls")))
    fresh = F.col("_c.valid") & ~F.coalesce("_valid", F.lit(False))
    return out.withColumn("valid", F.col("_c.valid")).withColumn("invalid_reason", F.col("_c.reason")).withColumn("counts", fresh).drop("_caption", "_images", "_valid", "_c")


def accept_recommendation(a: Column, b: Column, recommend: Column, keep: str = HAN) -> Column:
    """The recommendation if it only reuses characters of a and b, else empty.

    It must not be both texts in a row, nor longer than the union of their bags. One
    block is cut like a's lines.
    """
    given = F.filter(F.transform(F.split(F.replace(F.coalesce(recommend, F.lit("")), F.lit("\\n"), F.lit("\n")), "\n"), lambda x: to_traditional(strip(x))), lambda x: compact(x, keep) != "")
    count = lambda t, c: F.length(t) - F.length(F.replace(t, c, F.lit("")))
    union = lambda x, y: F.aggregate(F.array_distinct(F.split(F.concat(x, y), "")), F.lit(0), lambda n, c: n + F.when(c == "", 0).otherwise(F.greatest(count(x, c), count(y, c))))

    def judged(x: Column) -> Column:
        r = x["r"]
        one = compact(F.array_join(r, ""), keep)
        bad = (one == "") | ((x["ac"] == "") & (x["bc"] == "")) | has_invented_count(F.concat(x["a"], x["b"]), one, keep)
        both = (x["ac"] != "") & (x["bc"] != "") & one.isin(F.concat(x["ac"], x["bc"]), F.concat(x["bc"], x["ac"]))
        verses = F.filter(F.transform(lines(x["a"]), lambda t: compact(t, keep)), lambda t: t != "")
        cut = cut_by_template(one, verses)
        return F.when(bad | both | (F.length(one) > union(x["ac"], x["bc"])), "").otherwise(F.array_join(F.when((F.size(r) == 1) & (F.size(verses) >= 2) & (F.size(cut) == F.size(verses)), cut).otherwise(r), "\n"))

    ta, tb = to_traditional(strip(a)), to_traditional(strip(b))
    return let(F.struct(ta.alias("a"), tb.alias("b"), compact(ta, keep).alias("ac"), compact(tb, keep).alias("bc"), given.alias("r")), judged)


def fallback(a: Column, b: Column, pick: Column, keep: str = HAN) -> Column:
    """Struct (text, source): what to recommend without a model's text: the picked side, else a, else b."""
    p = F.lower(strip(pick))
    has = lambda t: compact(t, keep) != ""
    made = lambda t, s: F.struct(to_traditional(t).alias("text"), F.lit(s).alias("source"))
    return F.when((p == "b") & has(b), made(b, "fallback_b")).when(has(a), made(a, "fallback_a")).when(has(b), made(b, "fallback_b")).otherwise(F.struct(F.lit("").alias("text"), F.lit("glm_empty_ab").alias("source")))


@F.pandas_udf(ArrayType(IntegerType()))
def _places(s: pd.Series, r: pd.Series, bare_s: pd.Series, bare_r: pd.Series) -> pd.Series:
    """As many lines of r as of s: for each of s the place of its best unused line of r, -1 under half. More: for each of r that of its best line of s."""
    out = []
    for p, q, x, y in zip(*(map(list, c) for c in (s, r, bare_s, bare_r)), strict=True):
        places: list[int] = []
        if len(p) == len(q):
            index, free = Index.of(p, q), np.ones(len(q), bool)
            for k in range(len(p)):
                bag = np.where(free, index.bags(k, k + 1)[0][0], -1)
                at = int(bag.argmax())
                if bag[at] < 5_000:
                    places = [-1]
                    break
                free[at] = False
                places.append(at)
        elif len(p) and len(p) < len(q):
            index = Index.of(q, p)
            for k, whole in enumerate(y):
                bag = index.bags(k, k + 1)[0][0]
                if whole:
                    bag = np.maximum(bag, np.fromiter((9_900 if whole in z else 0 for z in x), np.int64, len(x)))
                places.append(int(bag.argmax()))
        out.append(places)
    return pd.Series(out, dtype=object)


def relock(source: Column, refined: Column, keep: str = HAN) -> Column:
    """Refined lines in the order of their source lines.

    As many lines: each source line takes its best unused one. More: each goes to its
    best source line, one that holds it first. Fewer: kept if the texts agree.
    """
    clean = lambda x: F.filter(F.transform(x, strip), lambda t: t != "")
    s, r = clean(source), clean(refined)
    each = lambda x, f: F.transform(x, lambda t: f(t, keep))
    order = _places(each(s, norm), each(r, norm), each(s, compact), each(r, compact))

    def equal(x: Column) -> Column:
        return F.when(F.array_contains(x["o"], -1), x["r"]).otherwise(F.transform(x["o"], lambda j: F.get(x["r"], j)))

    def split(x: Column) -> Column:
        keyed = F.transform(x["r"], lambda r, j: F.struct(F.get(x["o"], j).alias("p"), j.alias("j"), r.alias("r")))
        return F.transform(F.array_sort(keyed), lambda k: k["r"])

    def chosen(x: Column) -> Column:
        n, m = F.size(x["r"]), F.size(x["s"])
        whole = lambda k: F.array_join(x[k], "\n")
        agree = bag_dice(whole("s"), whole("r"), keep) >= 0.9
        return F.when(n == 0, x["s"]).when(m == 0, x["r"]).when(has_invented(whole("s"), whole("r"), keep), x["s"]).when(n == m, equal(x)).when(n > m, split(x)).when(agree, x["r"]).otherwise(x["s"])

    return let(F.struct(s.alias("s"), r.alias("r"), order.alias("o")), chosen)


def compare_to_truth(rows: DataFrame, truth: DataFrame, key: str, keep: str = HAN) -> DataFrame:
    """rows (ground_truth) against a table of truths (truth): error rate, bag and whether they agree."""
    out = rows.join(truth.select(key, "truth"), key)
    out = out.withColumn("cer", cer(F.col("truth"), F.col("ground_truth"), keep)).withColumn("bag", bag_dice(F.col("truth"), F.col("ground_truth"), keep))
    return out.withColumn("agree", (F.col("cer") <= 0.08) | (compact(F.col("truth"), keep) == compact(F.col("ground_truth"), keep)))


def judge_flags(gate_ok: Column, dropped: Column, retried: Column, source: Column, pick: Column, agree: Column, fused: Column, mismatch: Column, mix: Column) -> Column:
    """Sorted flags of a judged page."""
    p = F.lower(strip(pick))
    tests = [
        ("glm_gate_ok", gate_ok), ("glm_gate_fail", ~gate_ok), ("glm_dropped_invented", dropped), ("glm_retry", retried), ("glm_fallback", source.startswith("fallback")), ("glm_empty_ab", source == "glm_empty_ab"),
        ("glm_pick_a", p == "a"), ("glm_pick_b", p == "b"), ("glm_pick_neither", ~p.isin("a", "b")), ("glm_fuse_empty", blank(fused)), ("glm_agree_fuse", ~blank(fused) & agree), ("glm_disagree_fuse", ~blank(fused) & ~agree), ("glm_pick_mismatch", mismatch), ("glm_mix", mix),
    ]
    return F.array_sort(F.array_compact(F.array(*[F.when(when, name) for name, when in tests])))


# Titles of a table of contents, a title that is read in several spellings, and labels of its layout.
TITLES = ("TRIỀU GIA LONG", "TRIỀU MINH MỆNH")
LOOSE_TITLE = ("MỤC L", "CHÂU BẢN TRIỀU NGUYỄN", "MỤC LỤC CHÂU BẢN TRIỀU NGUYỄN")
LAYOUT_LABEL = r"(?iU)^\s*(tr[íi]ch\s+y[ếe]u|m[ụu]c\s+l[ụuựạ]c\s+ch[âa]u\s+b[ảa]n\s+tri[ềe]u\s+nguy[ễe]n)\s*$"
HEADER_HAN, HEADER_LATIN, WIDE_GAP = r"[\x{3400}-\x{9FFF}]", "[A-Za-zÀ-ỹ]", r"\t+| {3,}"


def title(line: Column) -> Column:
    """The known title that a line is, or null."""
    upper = F.upper(strip(F.regexp_replace(F.coalesce(line, F.lit("")), r"(?U)\s+", " ")))
    begin, part, whole = LOOSE_TITLE
    return F.when(upper.isin(*TITLES), upper).when(upper.startswith(begin) & upper.contains(part), whole)


def inspect_header(header: Column) -> Column:
    """Struct (page_header, raw_header, han, latin, action, suspicious) of a contents page's header.

    Below a known title, layout labels go and other lines are body text that leaked into
    the header: a line, or each part of a line between wide gaps, goes to the script that
    alone it holds. If any is of both or of neither, and under an unknown title, all
    stays as it is, for review.
    """
    none = F.lit(None).cast("string")

    def kind(part: Column) -> Column:
        h, l = part.rlike(HEADER_HAN), part.rlike(HEADER_LATIN)  # noqa: E741
        return F.struct(F.when(h & ~l, "han").when(l & ~h, "latin").otherwise("mixed").alias("kind"), part.alias("t"))

    def parts(line: Column) -> Column:
        return F.transform(F.filter(F.transform(F.split(line, WIDE_GAP), strip), lambda x: x != ""), kind)

    def result(head, raw, han, latin, action: str | Column, suspicious: bool) -> Column:
        text = lambda x: F.lit(x) if isinstance(x, str) else x
        return F.struct(head.alias("page_header"), raw.alias("raw_header"), text(han).alias("han"), text(latin).alias("latin"), text(action).alias("action"), F.lit(suspicious).alias("suspicious"))

    def judged(x: Column) -> Column:
        rest = F.filter(F.slice(x["lines"], F.lit(2), F.size(x["lines"])), lambda t: ~t.rlike(LAYOUT_LABEL))

        def leaked(p: Column) -> Column:
            of = lambda k: F.array_join(F.transform(F.filter(p, lambda q: q["kind"] == k), lambda q: q["t"]), "\n")
            unclear = F.exists(p, lambda q: q["kind"] == "mixed") | (F.size(p) == 0)
            return F.when(unclear, result(x["raw"], x["raw"], "", "", "review", True)).otherwise(result(x["title"], x["raw"], of("han"), of("latin"), "recovered_to_orphan", True))

        same = F.when(x["title"] != x["raw"], "normalized").otherwise("none")
        return (
            F.when(x["raw"] == "", result(none, none, "", "", "none", False))
            .when(x["title"].isNull(), result(x["raw"], x["raw"], "", "", "review", True))
            .when(F.size(x["lines"]) == 1, result(x["title"], x["raw"], "", "", same, False))
            .when(F.size(rest) == 0, result(x["title"], x["raw"], "", "", "label_dropped", False))
            .otherwise(let(F.flatten(F.transform(rest, parts)), leaked))
        )

    clean = strip(header)
    by_line = F.filter(F.transform(F.split(clean, r"\r\n|[\n\r]"), strip), lambda t: t != "")
    return let(F.struct(clean.alias("raw"), by_line.alias("lines"), title(F.get(by_line, F.lit(0))).alias("title")), judged)


def best_caption(candidates: DataFrame, key: str, name: str, text: str, priority: tuple[str, ...]) -> DataFrame:
    """One caption per key from nested fields: with content script first, then by the field's priority, then the longest."""
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col(name)).cast("int")
    order = F.struct(F.when(compact(F.col(text)) != "", 0).otherwise(1), F.when(rank > 0, rank).otherwise(len(priority) + 1), -F.length(text), F.col(text))
    return candidates.where(~blank(F.col(text))).groupBy(key).agg(F.min_by(text, order).alias("caption"))
