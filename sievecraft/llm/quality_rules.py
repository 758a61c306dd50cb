"""Quality rules: a decision list learned by sequential covering.

Statistics of each text are SQL expressions. A rule is a conjunction of thresholds
on them that rejects a text; rules are grown one after another on a growing fold by
information gain, pruned on a pruning fold, and kept while they stay precise there.
Each search step is one aggregation that counts labels by statistic and bin; the
driver sees at most STATS x BINS rows of it. The verdict is one ordered conditional
expression that Spark runs inside the plan; there is no Python on the executors.

Defined results: null text has no words and counts as empty; repeated rows each get
a row; with no usable labels the list is empty and only the base limits apply.
Extra columns are ignored. A repeated label takes its highest value.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, one_label_per_doc, save, table

BLANKS = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
#: Statistics that rules may test, from the counted columns.
STATS = {
    "words": "n_words",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_rate": "n_symbols / greatest(word_chars, 1)",
    "dup_line_rate": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_rate": "n_repeat_words / greatest(n_words, 1)",
    "distinct_rate": "n_distinct / greatest(n_words, 1)",
    "upper_rate": "n_upper / greatest(word_chars, 1)",
}
BINS = 64


def let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more among these words.

    Windows are sorted by hash, so equal ones are neighbours; their starts, in order,
    cover three words each, less what the next one covers again.
    """
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("at")))

    def starts(s: Column) -> Column:
        h = lambda i: F.get(s, i)["h"]
        twice = F.transform(F.sequence(F.lit(0), F.size(s) - 1), lambda i: F.when((h(i) == h(i - 1)) | (h(i) == h(i + 1)), F.get(s, i)["at"]))
        return F.sort_array(F.array_compact(twice))

    covered = F.aggregate(
        let(F.sort_array(windows), starts),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, at: F.struct((a["n"] + F.least(F.lit(3), at - a["last"])).alias("n"), at.alias("last")),
        lambda a: a["n"],
    )
    return F.when(F.size(words) >= 3, covered).otherwise(0)


def document_statistics(documents: DataFrame) -> DataFrame:
    """doc_id and the counts of every row of documents."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, BLANKS), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_BLANK))
    of_words = let(words, lambda w: F.struct(F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"), repeat_words(w).alias("n_repeat_words"), F.size(F.array_distinct(w)).alias("n_distinct")))
    of_lines = let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    found = documents.select(F.col("doc_id").cast("long").alias("doc_id"), of_words.alias("w"), of_lines.alias("l"), F.regexp_count(text, F.lit(SYMBOLS)).alias("n_symbols"), F.regexp_count(text, F.lit("[A-Z]")).alias("n_upper"))
    return found.select("doc_id", *[F.col(c).cast("long").alias(c.split(".")[-1]) for c in ("w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "w.n_distinct", "l.n_lines", "n_upper")])


@dataclass(frozen=True)
class Test:
    """stat >= at, or stat < at."""

    stat: str
    above: bool
    at: float

    def expression(self) -> Column:
        x = F.expr(STATS[self.stat])
        return x >= F.lit(self.at) if self.above else x < F.lit(self.at)

    def __str__(self) -> str:
        return f"{self.stat} {'>=' if self.above else '<'} {self.at:.6g}"


Rule = tuple[Test, ...]


def covers(rule: Rule) -> Column:
    out = F.lit(True)
    for t in rule:
        out = out & t.expression()
    return out


def verdict(rules: list[Rule]) -> Column:
    """The ordered list as one conditional: the first rule that matches rejects, else the text is kept."""
    out = F
    for rule in rules:
        out = out.when(covers(rule), F.lit(False))
    return out.otherwise(F.lit(True)) if rules else F.lit(True)


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    if not p:
        return -math.inf
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", max_rules: int = 8, max_tests: int = 3, precision: float = 0.95, min_covered: int = 5) -> list[Rule]:
    """Rules that reject, in order. Rows of label 0 are what a rule should cover.

    The training folds come from the id's crc32: fold 0 grows, fold 2 prunes; fold 1 is left to tests.
    """
    bad = one_label_per_doc(labels, label).select("doc_id", (1 - F.col("y")).alias("bad"))
    rows = stats.join(bad, "doc_id").where(fold(F.col("doc_id"), 3) != 1).withColumn("grow", fold(F.col("doc_id"), 3) == 0)
    rows = save(rows.select("*", *[F.expr(e).cast("double").alias(f"x_{k}") for k, e in STATS.items()]), "rule-training")

    cuts = F.lit([i / (BINS // 2) for i in range(1, BINS // 2)])
    marks = rows.groupBy("bad").agg(*[F.percentile_approx(f"x_{k}", cuts, 10000).alias(k) for k in STATS]).collect()
    marks = {k: sorted({x for r in marks for x in (r[k] or [])}) for k in STATS}
    if sum(map(len, marks.values())) == 0:
        return []
    reached = lambda k, v: F.size(F.filter(F.lit([float(x) for x in v]), lambda t: t <= F.col(f"x_{k}")))
    bins = [F.struct(F.lit(k).alias("stat"), reached(k, v).alias("bin")) for k, v in marks.items() if v]
    rows = save(rows.select("grow", "bad", *[c for c in stats.columns if c != "doc_id"], F.array(*bins).alias("bins")), "rule-bins")

    def best(inside: Column) -> tuple[float, Test, int] | None:
        """The test of most gain among rows of the growing fold."""
        found = rows.where(F.col("grow") & inside).select("bad", F.explode("bins").alias("b")).groupBy("b.stat", "b.bin").agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect()
        per: dict[str, dict[int, tuple[int, int]]] = {}
        for r in found:
            per.setdefault(r["stat"], {})[r["bin"]] = (r["p"], r["n"])
        top = None
        for stat in sorted(per):
            p0, n0 = (sum(v[i] for v in per[stat].values()) for i in (0, 1))
            if not p0:
                return None
            for k, at in enumerate(marks[stat]):
                p1, n1 = (sum(v[i] for b, v in per[stat].items() if b > k) for i in (0, 1))
                for above, p, n in ((True, p1, n1), (False, p0 - p1, n0 - n1)):
                    if p + n < p0 + n0 and p >= min_covered and (top is None or _gain(p, n, p0, n0) > top[0]):
                        top = (_gain(p, n, p0, n0), Test(stat, above, float(at)), n)
        return top

    rules: list[Rule] = []
    while len(rules) < max_rules:
        left, rule = verdict(rules), ()
        while len(rule) < max_tests and (found := best(left & covers(rule))) and found[0] > 0:
            rule += (found[1],)
            if found[2] == 0:
                break
        if not rule:
            break
        # Drop last tests while that does not lower (p - n) / (p + n) on the pruning fold.
        tries = [rule[:k] for k in range(1, len(rule) + 1)]
        counts = rows.where(~F.col("grow") & left).agg(*[F.sum(F.when(covers(r), v).otherwise(0)).alias(f"{c}{k}") for k, r in enumerate(tries) for c, v in (("p", F.col("bad")), ("n", 1 - F.col("bad")))]).first()
        worth = [((counts[f"p{k}"] or 0), (counts[f"n{k}"] or 0)) for k in range(len(tries))]
        k = max(range(len(tries)), key=lambda k: ((worth[k][0] - worth[k][1]) / max(1, sum(worth[k])), -k))
        if sum(worth[k]) == 0 or worth[k][0] < precision * sum(worth[k]):
            break
        rules.append(tries[k])
    return rules


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = save(document_statistics(table(spark, sf_dir, "documents")), "rule-statistics")
    rules = fit(stats, table(spark, sf_dir, "labels"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))
