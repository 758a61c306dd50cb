"""Similarity of pairs against small independent models."""

import random
from collections import Counter
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievecraft.functions import matching
from sievecraft.functions import pairs as m
from sievecraft.operators import alignment
from sievecraft.plans import catalogue
from sievecraft.plans.adapters import tracks

A, B = F.col("a"), F.col("b")


def test_error_rates(one):
    assert one(m.cer(A, B), a="竹雨", b="竹風雨月") == 1.0
    assert one(m.cer(A, B), a="", b="竹") == 1.0 and one(m.cer(A, B), a="", b="") == 0.0
    assert one(m.bag_dice(A, B), a="春風又綠", b="綠又風春") == 1.0
    assert one(m.cer(A, B), a="论远", b="論遠") == 0.0


def test_against_models(spark):
    rng = random.Random(3)
    rows = [("".join(rng.choices("abcd", k=rng.randint(0, 9))), "".join(rng.choices("abce", k=rng.randint(0, 9)))) for _ in range(60)]
    df = spark.createDataFrame(rows, "a string, b string")
    keep = "a-z"
    got = df.select("a", "b", m.bag_dice(A, B, keep).alias("bag"), m.sequence_ratio(A, B, keep).alias("ratio"), m.partial_ratio(A, B, keep).alias("partial"), m.has_invented_count(A, B, keep).alias("more"), m.repeats_differ(A, B, keep).alias("rep")).collect()
    for r in got:
        a, b = Counter(r.a), Counter(r.b)
        n = len(r.a) + len(r.b)
        assert r.bag == (1.0 if not n else round(2 * sum((a & b).values()) / n, 4))
        assert r.more == any(k > a[c] for c, k in b.items())
        top = max(len(r.a), len(r.b), 1)
        assert r.rep == any(k / top >= 0.4 and a[c] != b[c] for c, k in (a | b).items())
        if r.a and r.b:
            assert r.ratio == round(100 * SequenceMatcher(None, r.a, r.b, autojunk=False).ratio(), 2)
            s, t = sorted((r.a, r.b), key=len)
            common = max((k for k in range(1, len(s) + 1) for i in range(len(s) - k + 1) if s[i : i + k] in t), default=0)
            assert r.partial == round(100 * common / len(s), 2)


def test_lines(one):
    arr = lambda *x: F.array(*map(F.lit, x)) if x else F.array().cast("array<string>")
    assert one(m.line_wer(arr("一二", "三"), arr("一二", "四", "三"))) == 0.5
    assert one(m.line_wer(arr(), arr("一"))) == 1.0 and one(m.line_wer(arr(), arr())) == 0.0
    assert one(m.overlapping_lines(arr("春風"), arr("春山", "江水", "風"))) == ["春山", "風"]


def test_caption_vote(one):
    assert one(m.caption_pick(A, B, F.lit("春風")), a="春風", b="春雨") == "春風"
    assert one(m.caption_pick(A, B, F.lit("山")), a="春風", b="春雨") is None


def plain_blocks(x, y):
    plain = SequenceMatcher(None, x, y, autojunk=False)
    return sum(b.size for b in plain.get_matching_blocks()), plain.find_longest_match().size


@pytest.mark.parametrize("whole", [matching.WHOLE, 20])
def test_blocks_equal_difflib(monkeypatch, whole):
    """Whole batches; with few cells a table, long problems are searched by windows."""
    monkeypatch.setattr(matching, "WHOLE", whole)
    rng = random.Random(5)
    xs, ys = ["", "a", "", "same", "a" * 700 + "b" * 300, "\U0001f600b"], ["", "", "a", "same", "a" * 600 + "cb" * 200 + "b" * 260, "b\U0001f600"]
    for size, letters in ((7, "ab"), (40, "abcd"), (500, "ab"), (900, "abcdefghij")):
        for _ in range(12 if size < 100 else 2):
            x = "".join(rng.choices(letters, k=rng.randint(0, size)))
            for y in (x[size // 2 :] + x[: size // 3], "".join(c if rng.random() > 0.1 else rng.choice(letters) for c in x), x[::-1], "".join(rng.choices(letters, k=rng.randint(0, size)))):
                xs.append(x)
                ys.append(y)
    total, longest = matching.block_sizes(xs, ys)
    assert list(zip(total.tolist(), longest.tolist(), strict=True)) == [plain_blocks(x, y) for x, y in zip(xs, ys, strict=True)]
    assert matching.block_sizes(xs, ys, all_blocks=False)[1].tolist() == longest.tolist()
    assert [x.tolist() for x in matching.block_sizes([], [])] == [[], []]


def plain_distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def test_distance_equals_a_plain_table(monkeypatch):
    rng = np.random.default_rng(4)
    for k in (1, 2, 5, 60):
        for _ in range(40):
            a = rng.integers(0, k, rng.integers(0, 60))
            b = a[rng.random(len(a)) > 0.1] if rng.random() < 0.5 else rng.integers(0, k, rng.integers(0, 60))
            monkeypatch.setattr(matching, "NEAR", int(rng.choice([1, 4, 32])))
            assert matching.distance(a, b) == plain_distance(a.tolist(), b.tolist())


def test_error_rate_of_a_page_of_100_000_lines(spark):
    """More distinct lines than a text's characters could stand for; a few slips, and pages that share nothing."""
    rows = spark.range(2).select("id", F.transform(F.sequence(F.lit(0), F.lit(99_999)), lambda i: F.concat(F.lit("w"), F.translate(i.cast("string"), "0123456789", "abcdefghij"))).alias("a"))
    rows = rows.withColumn("b", F.when(F.col("id") == 0, F.filter("a", lambda t: ~t.isin("wbaaa", "wcaaa"))).otherwise(F.array(F.lit("wx"))))
    got = {r.id: r.wer for r in rows.select("id", m.line_wer(F.col("a"), F.col("b"), "a-z").alias("wer")).collect()}
    assert got == {0: round(2 / 100_000, 4), 1: 1.0}


def test_page_rate_equals_rate(spark):
    rng = random.Random(8)
    rows = [("".join(rng.choices("abc", k=rng.randint(0, 90))), "".join(rng.choices("abcd", k=rng.randint(0, 90)))) for _ in range(50)] + [("", ""), ("", "a"), ("a", "")]
    got = spark.createDataFrame(rows, "a string, b string").select(m.cer(A, B, "a-z").alias("x"), m.page_cer(A, B, "a-z").alias("y")).collect()
    assert all(r.x == r.y for r in got)


def test_ratios_in_sql_text(spark):
    m.register(spark)
    spark.createDataFrame([("論遠春", "论远山"), (None, None), ("春風", None), ("abc", "abd"), ("春風又綠", "又綠江南岸")], "a string, b string").createOrReplaceTempView("ratio_pairs")
    got = spark.sql("select sequence_ratio(a, b) as r, partial_ratio(a, b) as p from ratio_pairs").collect()
    same = spark.table("ratio_pairs").select(m.sequence_ratio(A, B).alias("r"), m.partial_ratio(A, B).alias("p")).collect()
    assert got == same and (got[0].r, got[0].p, got[1].r, got[2].r) == (66.67, 66.67, 100.0, 0.0)


def test_ratios_take_whole_turns(spark, tmp_path):
    x, y = "a" * 200 + "b" * 200, "a" * 200 + "c" * 300
    spark.createDataFrame([(1, 1, x), (1, 2, y)], "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = catalogue.QUERIES["m5_ratios"](spark, str(tmp_path)).first()
    assert (got.ratio, got.partial) == (44.44, 50.0)


def pair_score(x, y):
    """The higher of Dice and the longest common run's share, in hundredths; equal texts: all."""
    n = len(x) + len(y)
    bag = 10_000 if n == 0 else round(20_000 * sum((Counter(x) & Counter(y)).values()) / n)
    return max(bag, round(10_000 * plain_blocks(x, y)[1] / min(len(x), len(y)))) if x and y else bag


def plain_pairs(xs, ys):
    """Each line takes the best line that is left, in order."""
    free, out = dict(enumerate(ys)), []
    for x in xs:
        at = max(free, key=lambda j: (pair_score(x, free[j]), -j), default=-1)
        at = at if at >= 0 and pair_score(x, free[at]) >= (4000 if len(x) <= 2 else 5500) else -1
        free.pop(at, None)
        out.append(at)
    return out


def random_page(rng, letters):
    line = lambda: "".join(rng.choices(letters, k=rng.choice([0, 1, 2, 3, 5, 8, 20, 40])))
    xs = [line() for _ in range(rng.randint(0, 12))]
    ys = [rng.choice([x, x[: len(x) // 2], line() + x[1:] + line(), line()]) for x in xs] + [line(), line()]
    rng.shuffle(ys)
    return xs, ys


def test_index_equals_all_pairs(spark, monkeypatch):
    rng = random.Random(11)
    pages = [random_page(rng, rng.choice(["ab", "abcdefgh", "abcdefghijklmnopqrstuvwxyz"])) for _ in range(60)]
    want = [plain_pairs(x, y) for x, y in pages]
    rows = spark.createDataFrame([(k, x, y) for k, (x, y) in enumerate(pages)] + [(99, None, None)], "page int, a array<string>, b array<string>")
    got = {r.page: r.took for r in alignment.partners(rows, "a", "b", "a-z").collect()}
    assert got.pop(99) == [] and [got[k] for k in range(len(pages))] == want
    # All pages count as long: blocks of three lines.
    for name, value in (("LONG", 0), ("BLOCK", 3)):
        monkeypatch.setattr(alignment, name, value)
    got = {r.page: r.took for r in alignment.partners(rows, "a", "b", "a-z").collect()}
    assert [got[k] for k in range(len(pages))] == want


def test_a_page_of_5000_lines(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(4000)]
    lines = ["".join(rng.choices(words, k=12)) for _ in range(5000)]
    rows = spark.createDataFrame([(1, lines, [x[:9] + x[10:] for x in reversed(lines)])], "page int, a array<string>, b array<string>")
    assert alignment.partners(rows, "a", "b", "a-z").first().took == list(range(4999, -1, -1))


def test_line_queries_take_whole_lines(spark, tmp_path):
    line = "a" * 60 + "b" * 40
    other = "c" * 60 + "d" * 40
    spark.createDataFrame([(4, f"{line}\n{other}"), (5, f"{line}\n{other}")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    run = lambda name: catalogue.QUERIES[name](spark, str(tmp_path)).orderBy("image").collect()
    # Document 4's second track is the first half of each line, document 5's is equal.
    assert {(r.text_a, r.text_b, r.cer) for r in run("f1_align_lines") if r.image == "4"} == {(line, line[:50], 0.5), (other, other[:50], 0.5)}
    assert {r.line for r in run("f6_fuse_lines")} == {line, other}
    assert [r.page_status for r in run("f10_page_status")] == ["needs_hitl", "silver"]
    assert [set(r.lines.split("\n")) for r in run("f4_relock")] == [{line, other}] * 2


def test_pages_of_one_file_are_dealt_out(spark, tmp_path):
    spark.range(40).select(F.col("id").alias("doc_id"), F.lit("one line\nanother").alias("text")).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    assert tracks(spark, str(tmp_path)).select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_runs_and_distances_of_texts():
    rng = random.Random(5)
    for _ in range(400):
        x = "".join(rng.choices("ab", k=rng.randint(1, 30)))
        y = rng.choice([x[1:] + "a", x[: len(x) // 2], "b" + x, x[:3] + x[4:], "".join(rng.choices("ab", k=20))])
        run = max([n for n in range(1, len(x) + 1) for i in range(len(x) - n + 1) if x[i : i + n] in y], default=0)
        for least in range(1, len(x) + 1):
            got = matching.longest_run(x, y, least)
            assert got == run if run >= least else got < least
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            row, old = [i], row
            for j, d in enumerate(y, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (c != d)))
        assert matching.text_distance(x, y) == row[-1]


def test_distances_of_a_batch(monkeypatch):
    """All ways in which a distance is found, for pairs of several numbers' places."""
    rng = random.Random(7)
    xs, ys = [], []
    for letters in ("ab", "abcde", "abcdefghijklmnopqrstuvwxyz"):
        for _ in range(40):
            x = "".join(rng.choices(letters, k=rng.choice([0, 1, 5, 63, 64, 65, 130, 200])))
            xs.append(x)
            ys.append(rng.choice([x[::-1], "".join(c for c in x if rng.random() > 0.1), "".join(rng.choice(letters) if rng.random() < 0.05 else c for c in x), "".join(rng.choices(letters, k=rng.randint(0, 150)))]))
    want = [plain_distance(x, y) for x, y in zip(xs, ys, strict=True)]
    assert matching.text_distances(xs, ys) == want
    for name, value in (("NEAR_FROM", 1), ("NEAR", 3), ("PAIRS", 1), ("NUMBERS", 7), ("PLACE_TABLE", 1), ("FEW", 2)):
        monkeypatch.setattr(matching, name, value)
        assert matching.text_distances(xs, ys) == want, name


def test_blocks_of_pages_cut_at_seeds(monkeypatch):
    rng = random.Random(9)
    monkeypatch.setattr(matching, "SEED_CELLS", 0)
    xs, ys = [], []
    for _ in range(40):
        lines = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 60))) for _ in range(9)]
        x = "".join(rng.choices(lines, k=9))
        xs += [x] * 3
        ys += ["".join(rng.choices(lines, k=9)), "".join(c for c in x if rng.random() > 0.03), x[len(x) // 2 :] + x[: len(x) // 2]]
    for places in (0, matching.SEED_HITS):
        monkeypatch.setattr(matching, "SEED_HITS", places)
        total, longest = matching.block_sizes(xs, ys)
        assert list(zip(total.tolist(), longest.tolist(), strict=True)) == [plain_blocks(x, y) for x, y in zip(xs, ys, strict=True)]
    assert {(i, j, n) for i, j, n in matching.segments("abcdefgx", "yabcdefg", 2)} == {(0, 1, 7)}


def test_facts_of_lines_equal_columns(spark):
    """Simplified, variant and other characters; a character left out; null lines."""
    rng = random.Random(12)
    letters = "论論远遠脩修爲為裏裡春風ab，\U0001f600"
    line = lambda: rng.choice([None, "", "".join(rng.choices(letters, k=rng.randint(1, 9)))])
    rows = [(line(), line()) for _ in range(80)] + [("春春春風", "春風風風"), ("脩修修", "修")]
    df = spark.createDataFrame(rows, "a string, b string")
    x, y = m.norm(A), m.norm(B)
    want = df.select(F.length(x).alias("size_a"), F.length(y).alias("size_b"), (x == y).alias("equal"), ((y != "") & F.contains(x, y)).alias("inside"), m.repeats_differ(A, B).alias("repeats")).collect()
    assert [tuple(r.f) for r in df.select(m.line_facts()(A, B).alias("f")).collect()] == [tuple(r) for r in want] and any(r.repeats for r in want) and any(r.inside and not r.equal for r in want)
    lists = spark.createDataFrame([([a for a, _ in rows], [b for _, b in rows]), (None, []), ([], None)], "a array<string>, b array<string>")
    r = lists.select(m.page_facts()(A, B).alias("f"), m.page_matched()(A, B).alias("n"), m.line_wer(A, B).alias("wer"), m.bag_dice(F.array_join(A, ""), F.array_join(B, "")).alias("bag"), m.page_cer(F.array_join(A, ""), F.array_join(B, "")).alias("cer"), m.sequence_ratio(F.array_join(A, ""), F.array_join(B, "")).alias("ratio")).select(m.wer_of(F.col("f")), "wer", m.dice_of(F.col("f")), "bag", m.rate_of(F.col("f")), "cer", m.ratio_of({"size_a": F.col("f.size_a"), "size_b": F.col("f.size_b"), "equal": F.col("f.equal"), "matched": F.col("n")}), "ratio").collect()
    assert tuple(r[0])[::2] == tuple(r[0])[1::2] and tuple(r[1])[::2] == (0.0, 1.0, 0.0, 100.0)


def test_blocks_of_long_pages_are_dealt_out(spark, monkeypatch):
    """A few bytes are not put into one task: the blocks of a page are as many tasks' work."""
    for name, value in (("LONG", 0), ("BLOCK", 1)):
        monkeypatch.setattr(alignment, name, value)
    rows = spark.createDataFrame([(k, [f"a{k}b", "cd", "efg", "hij"], ["cd", "xy"]) for k in range(8)], "page int, a array<string>, b array<string>").coalesce(1)
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    assert [r.took for r in alignment.partners(rows, "a", "b", "a-z").orderBy("page").collect()] == [[-1, 0, -1, -1]] * 8
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    stages = [spark.sparkContext.statusTracker().getStageInfo(s) for j in jobs[: len(jobs) - before] for s in spark.sparkContext.statusTracker().getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) >= 16
