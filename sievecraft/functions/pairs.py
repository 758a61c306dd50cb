"""Similarity of two texts, as columns over a table of pairs.

Texts are compared in the form of ``text.norm``. Scores are rounded before any
threshold is tested, half to even. All are SQL expressions but the two block-matching
ratios and the distance between lists of lines, which run over whole Arrow batches
(see ``matching``). All take whole texts of any length.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StructField, StructType

from .base import chars, let
from .forms import Lines, python_class, shared_counts, tables, texts_of
from .forms import repeats_differ as repeated
from .matching import block_sizes, distance, list_distances, text_distances
from .text import HAN, SIMPLIFIED, TRADITIONAL, VARIANT_OF, VARIANTS, compact, norm, to_traditional

#: Characters in all matching blocks of a pair, and in its longest one.
BLOCKS = StructType([StructField("matched", LongType()), StructField("longest", LongType())])


def edit_distance(a: Column, b: Column) -> Column:
    return F.levenshtein(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))


def cer(reference: Column, other: Column, keep: str = HAN) -> Column:
    """Edit distance over the reference's length; may pass 1. Both empty: 0; only the reference empty: 1."""
    both = F.struct(norm(reference, keep).alias("a"), norm(other, keep).alias("b"))
    return let(both, lambda x: F.when((x["a"] == "") & (x["b"] == ""), 0.0).when(x["a"] == "", 1.0).when(x["a"] == x["b"], 0.0).otherwise(F.bround(F.levenshtein(x["a"], x["b"]) / F.length(x["a"]), 4)))


def rate_of(x: Column) -> Column:
    """``cer`` of two texts of which sizes, equality and edits are known."""
    return F.when(x["equal"], 0.0).when(x["size_a"] == 0, 1.0).otherwise(F.bround(x["edits"] / x["size_a"], 4))


def dice_of(x: Column) -> Column:
    """``bag_dice`` of two texts of which sizes, equality and shared characters are known."""
    return F.when(x["equal"], 1.0).otherwise(F.bround(2.0 * x["shared"] / (x["size_a"] + x["size_b"]), 4))


def ratio_of(x: Column) -> Column:
    """``sequence_ratio`` of two texts of which sizes, equality and characters in matching blocks are known."""
    none = (x["size_a"] == 0) | (x["size_b"] == 0)
    return F.when(x["equal"], 100.0).when(none, 0.0).otherwise(F.bround(2.0 * x["matched"] / F.greatest(x["size_a"] + x["size_b"], F.lit(1)) * 100, 2))


def partial_of(x: Column) -> Column:
    """``partial_ratio`` of two texts of which sizes, equality and the longest common run are known."""
    none = (x["size_a"] == 0) | (x["size_b"] == 0)
    return F.when(x["equal"], 100.0).when(none, 0.0).otherwise(F.bround(100.0 * x["longest"] / F.least(x["size_a"], x["size_b"]), 2))


@F.pandas_udf(LongType())
def _line_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    def coded(p, q) -> int:
        known: dict[str, int] = {}
        code = lambda lines: np.array([known.setdefault(t, len(known)) for t in lines], np.int64)
        return distance(code(p), code(q))

    return pd.Series([coded(p, q) for p, q in zip(a, b, strict=True)])


@F.pandas_udf(LongType())
def _char_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(text_distances(a.tolist(), b.tolist()), dtype="int64")


def page_cer(reference: Column, other: Column, keep: str = HAN) -> Column:
    """``cer`` of whole pages, whose lengths' product is too much for a table of the distances."""
    a, b = norm(reference, keep), norm(other, keep)
    return F.when((a == "") & (b == ""), 0.0).when(a == "", 1.0).otherwise(F.bround(_char_distance(a, b) / F.length(a), 4))


def line_wer(reference: Column, other: Column, keep: str = HAN) -> Column:
    """Edit distance between two arrays of lines, over the number of reference lines. Both empty: 0; only the reference empty: 1."""
    kept = lambda x: F.filter(F.transform(F.coalesce(x, F.array().cast("array<string>")), lambda t: norm(t, keep)), lambda t: t != "")
    a, b = kept(reference), kept(other)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 0.0).when(F.size(a) == 0, 1.0).otherwise(F.bround(_line_distance(a, b) / F.size(a), 4))


def shared_chars(a: Column, b: Column) -> Column:
    """Size of the multiset intersection of two texts' characters."""
    count = lambda t, c: F.length(t) - F.length(F.replace(t, c, F.lit("")))
    return F.aggregate(F.array_distinct(chars(a)), F.lit(0), lambda n, c: n + F.least(count(a, c), count(b, c)))


def bag_dice(a: Column, b: Column, keep: str = HAN) -> Column:
    """Dice of the two bags of characters; both empty: 1."""
    return bag_of_norms(norm(a, keep), norm(b, keep))


def bag_of_norms(x: Column, y: Column) -> Column:
    """bag_dice of two texts in the form of ``norm``."""
    total = lambda x: F.length(x["a"]) + F.length(x["b"])
    return let(F.struct(x.alias("a"), y.alias("b")), lambda x: F.when(x["a"] == x["b"], 1.0).otherwise(F.bround(2.0 * shared_chars(x["a"], x["b"]) / total(x), 4)))


@F.pandas_udf(BLOCKS)
def _blocks(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    matched, longest = block_sizes(a.tolist(), b.tolist())
    return pd.DataFrame({"matched": matched, "longest": longest})


#: Of two texts: sizes in the form of ``norm``, whether they are equal in it, whether the first holds the second, not empty, and ``repeats_differ``.
FACTS = StructType([StructField("size_a", LongType()), StructField("size_b", LongType()), StructField("equal", BooleanType()), StructField("inside", BooleanType()), StructField("repeats", BooleanType())])


def _facts(a: pa.Array, b: pa.Array, keep: str) -> pa.Array:
    plain, form, _ = tables(keep)
    lines = Lines(a), Lines(b)
    forms = [x.form(form) for x in lines]
    x, y = (texts_of(*f) for f in forms)
    repeats = repeated(*lines[0].form(plain), *lines[1].form(plain))
    flags = [[p == q for p, q in zip(x, y, strict=True)], [q != "" and q in p for p, q in zip(x, y, strict=True)], repeats]
    return pa.StructArray.from_arrays([*(pa.array(np.diff(f[1])) for f in forms), *(pa.array(v, pa.bool_()) for v in flags)], names=FACTS.names)


def line_facts(keep: str = HAN, lists: bool = False):
    """A function of two columns of texts, or of lists of texts, that gives FACTS of each pair."""

    def of_texts(a: pa.Array, b: pa.Array) -> pa.Array:
        return _facts(a, b, keep)

    def of_lists(a: pa.Array, b: pa.Array) -> pa.Array:
        ends = np.concatenate([[0], pc.list_value_length(a).to_numpy(zero_copy_only=False).cumsum()])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _facts(a.flatten(), b.flatten(), keep))

    return F.arrow_udf(of_lists, ArrayType(FACTS)) if lists else F.arrow_udf(of_texts, FACTS)


#: Of a page's two readings: what PAIR of alignment has of their whole texts but the blocks, and their lines that are not empty, with their edits.
PAGE = StructType([StructField(c, LongType()) for c in ("size_a", "size_b", "shared", "edits", "lines_a", "lines_b", "line_edits")] + [StructField("equal", BooleanType())])


def page_facts(keep: str = HAN):
    """A function of two columns of lists of lines that gives PAGE; line ends must not be content characters."""
    if re.match(f"[{python_class(keep)}]", "\n"):
        raise ValueError("line ends are content characters")

    def measured(a: pa.Array, b: pa.Array) -> pa.Array:
        form = tables(keep)[1]
        sides = [Lines(a), Lines(b)]
        forms = [x.form(form) for x in sides]
        pages = [(flat, at[x.ends]) for x, (flat, at) in zip(sides, forms, strict=True)]
        x, y = (texts_of(*p) for p in pages)
        known: dict[str, int] = {}
        kept = [[[t for t in lines[s:e] if t] for s, e in zip(side.ends[:-1].tolist(), side.ends[1:].tolist(), strict=True)] for side, lines in ((side, texts_of(*f)) for side, f in zip(sides, forms, strict=True))]
        line_edits = list_distances(kept[0], kept[1], lambda lines: np.array([known.setdefault(t, len(known)) for t in lines], np.int64))
        values = [np.diff(pages[0][1]), np.diff(pages[1][1]), shared_counts(*pages[0], *pages[1]), text_distances(x, y), [len(t) for t in kept[0]], [len(t) for t in kept[1]], line_edits]
        return pa.StructArray.from_arrays([*(pa.array(v, pa.int64()) for v in values), pa.array([p == q for p, q in zip(x, y, strict=True)], pa.bool_())], names=PAGE.names)

    return F.arrow_udf(measured, PAGE)


def page_matched(keep: str = HAN):
    """A function of two columns of lists of lines that gives the characters in all matching blocks of the whole texts."""

    def measured(a: pa.Array, b: pa.Array) -> pa.Array:
        sides = [(flat, at[x.ends]) for x in (Lines(a), Lines(b)) for flat, at in [x.form(tables(keep)[1])]]
        return pa.array(block_sizes(*(texts_of(*p) for p in sides))[0], pa.int64())

    return F.arrow_udf(measured, LongType())


def wer_of(x: Column) -> Column:
    """``line_wer`` of two pages of which lines and their edits are known."""
    return F.when((x["lines_a"] == 0) & (x["lines_b"] == 0), 0.0).when(x["lines_a"] == 0, 1.0).otherwise(F.bround(x["line_edits"] / x["lines_a"], 4))


@F.pandas_udf(LongType())
def _longest(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(block_sizes(a.tolist(), b.tolist(), all_blocks=False)[1])


def _sized(x: Column, y: Column, **found: Column) -> dict[str, Column]:
    """What the ratios read of two texts in the form of ``norm``."""
    return {"size_a": F.length(x), "size_b": F.length(y), "equal": x == y, **found}


def sequence_ratio(a: Column, b: Column, keep: str = HAN) -> Column:
    """Ratcliff-Obershelp similarity, 0 to 100."""
    x, y = norm(a, keep), norm(b, keep)
    return ratio_of(_sized(x, y, matched=_blocks(x, y)["matched"]))


def partial_ratio(a: Column, b: Column, keep: str = HAN) -> Column:
    """Longest common substring over the shorter text, 0 to 100."""
    x, y = norm(a, keep), norm(b, keep)
    return partial_of(_sized(x, y, longest=_longest(x, y)))


def with_ratios(rows: DataFrame, a: Column, b: Column, keep: str = HAN, ratio: str = "ratio", partial: str = "partial_ratio") -> DataFrame:
    """rows with sequence_ratio and partial_ratio of two columns, from one search."""
    rows = rows.withColumns({"_x": norm(a, keep), "_y": norm(b, keep)}).withColumn("_blocks", _blocks("_x", "_y"))
    known = _sized(F.col("_x"), F.col("_y"), matched=F.col("_blocks.matched"), longest=F.col("_blocks.longest"))
    return rows.withColumns({ratio: ratio_of(known), partial: partial_of(known)}).drop("_x", "_y", "_blocks")


def register(spark: SparkSession, keep: str = HAN) -> None:
    """The two ratios as functions of SQL text: ``select sequence_ratio(a, b), partial_ratio(a, b)``. Null counts as empty."""
    class_ = re.compile(f"[^{python_class(keep)}]")
    table = {ord(s): t for s, t in zip(SIMPLIFIED, TRADITIONAL, strict=True)}
    fold = {ord(s): t for s, t in zip(VARIANTS, VARIANT_OF, strict=True)}

    def prepared(texts: pd.Series) -> list[str]:
        return [class_.sub("", (t or "").translate(table)).translate(fold) for t in texts.tolist()]

    def rounded(share: np.ndarray, x: list[str], y: list[str]) -> pd.Series:
        none = np.array([not p or not q for p, q in zip(x, y, strict=True)])
        same = np.array([p == q for p, q in zip(x, y, strict=True)])
        return pd.Series(np.where(same, 100.0, np.where(none, 0.0, np.round(share, 2))))

    @F.pandas_udf(DoubleType())
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        x, y = prepared(a), prepared(b)
        return rounded(200.0 * block_sizes(x, y)[0] / np.maximum(1, [len(p) + len(q) for p, q in zip(x, y, strict=True)]), x, y)

    @F.pandas_udf(DoubleType())
    def partial(a: pd.Series, b: pd.Series) -> pd.Series:
        x, y = prepared(a), prepared(b)
        return rounded(100.0 * block_sizes(x, y, all_blocks=False)[1] / np.maximum(1, [min(len(p), len(q)) for p, q in zip(x, y, strict=True)]), x, y)

    spark.udf.register("sequence_ratio", ratio)
    spark.udf.register("partial_ratio", partial)


def longest_common(a: Column, b: Column, keep: str = HAN, caps: tuple[int, int] | None = None) -> Column:
    """Length of the longest common substring of the content characters; caps cut both sides first."""
    x, y = compact(a, keep), compact(b, keep)
    if caps:
        x, y = F.substring(x, 1, caps[0]), F.substring(y, 1, caps[1])
    return F.when((x == "") | (y == ""), 0).when(x == y, F.length(x)).otherwise(_longest(x, y).cast("int"))


def has_invented(raw: Column, refined: Column, keep: str = HAN) -> Column:
    """refined holds a content character that raw does not."""
    return F.size(F.array_except(chars(compact(refined, keep)), chars(compact(raw, keep)))) > 0


def has_invented_count(raw: Column, refined: Column, keep: str = HAN) -> Column:
    """refined holds a content character more often than raw."""
    both = F.struct(compact(raw, keep).alias("a"), compact(refined, keep).alias("b"))
    return let(both, lambda x: shared_chars(x["b"], x["a"]) < F.length(x["b"]))


def repeats_differ(a: Column, b: Column, keep: str = HAN) -> Column:
    """A character that is two fifths of the longer side is not as frequent on both sides."""
    both = F.struct(compact(to_traditional(a), keep).alias("a"), compact(to_traditional(b), keep).alias("b"))
    count = lambda t, c: F.length(t) - F.length(F.replace(t, c, F.lit("")))

    def found(x: Column) -> Column:
        n = F.greatest(F.length(x["a"]), F.length(x["b"]), F.lit(1))
        return F.exists(F.array_distinct(chars(F.concat(x["a"], x["b"]))), lambda c: (F.greatest(count(x["a"], c), count(x["b"], c)) / n >= 0.4) & (count(x["a"], c) != count(x["b"], c)))

    return let(both, found)


def caption_pick(a: Column, b: Column, hint: Column, keep: str = HAN) -> Column:
    """The side whose one differing character the caption's hint holds; null if it does not decide."""
    both = F.struct(compact(to_traditional(a), keep).alias("a"), compact(to_traditional(b), keep).alias("b"))

    def picked(x: Column) -> Column:
        differ = F.filter(F.arrays_zip(chars(x["a"]).alias("p"), chars(x["b"]).alias("q")), lambda z: z["p"] != z["q"])
        one = lambda d: F.when(F.contains(hint, d["p"]) & ~F.contains(hint, d["q"]), to_traditional(a)).when(F.contains(hint, d["q"]) & ~F.contains(hint, d["p"]), to_traditional(b))
        return F.when((hint != "") & (F.length(x["a"]) == F.length(x["b"])), let(differ, lambda d: F.when(F.size(d) == 1, one(F.get(d, F.lit(0))))))

    return let(both, picked)


def clamp(value: Column, default: float = 0.0) -> Column:
    """A confidence: a number between 0 and 1, rounded to four places."""
    return F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(value.cast("double"), F.lit(default)))), 4)


def line_confidence(cer_value: Column, ratio: Column) -> Column:
    return clamp(F.round(0.5 * (1.0 - cer_value) + 0.5 * (ratio / 100.0), 10))


def overlapping_lines(anchor: Column, other: Column, share: float = 0.5, keep: str = HAN) -> Column:
    """Lines of other of which at least the share of characters stands in the anchor's lines."""
    source = compact(F.array_join(anchor, ""), keep)

    def enough(line: Column, s: Column) -> Column:
        return let(chars(compact(line, keep)), lambda c: (F.size(c) > 0) & (F.size(F.filter(c, lambda x: F.contains(s, x))) / F.size(c) >= share))

    return let(source, lambda s: F.when(s == "", other).otherwise(F.filter(other, lambda x: enough(x, s))))


def best_order(ltr: Column, rtl: Column, grid: Column, truth: Column, keep: str = HAN) -> Column:
    """Struct of three common lengths with the truth and the order of the highest; tie if two are."""
    n = {k: longest_common(t, truth, keep, (80, 200)) for k, t in (("ltr", ltr), ("rtl", rtl), ("grid", grid))}
    all_three = F.struct(*[v.alias(k) for k, v in n.items()])

    def named(x: Column) -> Column:
        ranked = F.sort_array(F.array(x["ltr"], x["rtl"], x["grid"]), asc=False)
        top = F.when(F.get(ranked, F.lit(0)) == F.get(ranked, F.lit(1)), "tie").when(x["ltr"] == F.get(ranked, F.lit(0)), "ltr_columns").when(x["rtl"] == F.get(ranked, F.lit(0)), "rtl_columns").otherwise("grid")
        return F.struct(x["ltr"].alias("ltr_common"), x["rtl"].alias("rtl_common"), x["grid"].alias("grid_common"), top.alias("best_order"))

    return named(all_three)
