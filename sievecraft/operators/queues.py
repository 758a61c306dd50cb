"""Work queues: batches, shards, and round-robin selection.

A position over a whole table comes from a range sort and the counts of its
partitions, never from one task that numbers all rows.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import save


def global_index(rows: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """rows with ``idx`` from 0 in the given (total) order, and their number."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # Saved: a row must have the same place when it is counted and when it is read.
    placed = save(placed.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "index")
    counts = sorted((r["_part"], r["count"]) for r in placed.groupBy("_part").count().collect())
    before = [0, *accumulate(n for _, n in counts)]
    if not counts:
        return placed.select("*", F.lit(0).cast("long").alias("idx")).drop("_part", "_at"), 0
    offset = F.element_at(F.create_map(*[F.lit(x) for (p, _), b in zip(counts, before, strict=False) for x in (p, b)]), F.col("_part"))
    return placed.withColumn("idx", F.col("_at") + offset).drop("_part", "_at"), before[-1]


def contiguous_split(rows: DataFrame, n_batches: int, *order: str) -> DataFrame:
    """rows with ``batch`` from 0: contiguous parts, of which the last ones are one longer."""
    n = max(1, n_batches)
    indexed, total = global_index(rows, *order)
    base, rest = divmod(total, n)
    cut = (n - rest) * base
    idx = F.col("idx")
    batch = F.when(idx < cut, F.floor(idx / max(base, 1))).otherwise((n - rest) + F.floor((idx - cut) / (base + 1)))
    return indexed.withColumn("batch", batch.cast("int")).drop("idx")


def round_robin_shards(rows: DataFrame, n_workers: int, base_seq: int, *order: str) -> DataFrame:
    """rows dealt in turn to at most n_workers shards, numbered down from base_seq."""
    indexed, total = global_index(rows, *order)
    n = max(1, min(n_workers, total))
    return indexed.withColumn("seq", (F.lit(base_seq) - F.pmod(F.col("idx"), F.lit(n))).cast("int")).drop("idx")


def select_chunk(queue: DataFrame, done: DataFrame, seq: str, key: str, target: int, *order: str, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, report): rows of the queues not done yet, one of each queue in turn, up to target (all if 0 or less).

    rows: the queue's columns and ``turn`` from 1. report: one row of selected,
    skipped_done, target, chunk_full (1 if the target was reached). Queues are gone
    through in order, so of the done rows those count as skipped that stand before a
    queue's last selected row, or all of a queue that was found to be at its end.

    A row's place in its queue is its place among all rows less that of the queue's first
    one, so no task holds a queue, and how many turns are full is found from the queues'
    sizes. ``force`` takes done rows too. Rows with a blank key or a null queue are left out.
    """
    is_done = F.lit(False) if force else F.col("_done").isNotNull()
    known = done.select(F.col(key).alias("_key")).distinct().withColumn("_done", F.lit(True))
    rows = queue.where(F.col(seq).isNotNull() & F.col(key).isNotNull() & (F.trim(F.col(key)) != "")).join(known, F.col(key) == F.col("_key"), "left").withColumn("_is_done", is_done).drop("_key", "_done")
    placed, _ = global_index(rows, seq, *order)
    placed = placed.withColumnRenamed("idx", "_place")
    pending, total = global_index(placed.where(~F.col("_is_done")), seq, "_place")
    sizes = save(placed.groupBy(seq).agg(F.count_if(~F.col("_is_done")).alias("_n")), "queue-sizes")
    pending = pending.join(pending.groupBy(seq).agg(F.min("idx").alias("_first")), seq).withColumn("turn", F.col("idx") - F.col("_first") + 1).drop("idx", "_first")
    full = 0 < target <= total
    if full:
        taken = lambda turns: sizes.agg(F.sum(F.least(F.col("_n"), F.lit(turns)))).first()[0] or 0
        low, high = 0, target
        while low < high:
            turns = (low + high + 1) // 2
            low, high = (turns, high) if taken(turns) <= target else (low, turns - 1)
        # The next turn is cut: the first queues that still have a row get one each.
        rest = target - taken(low)
        last = sizes.where(F.col("_n") > low).orderBy(seq).limit(rest).select(seq, F.lit(True).alias("_one_more"))
        chosen = pending.join(last, seq, "left").where((F.col("turn") <= low) | ((F.col("turn") == low + 1) & F.col("_one_more"))).drop("_one_more")
    else:
        chosen = pending
    chosen = save(chosen, "queue-chosen")
    ends = chosen.groupBy(seq).agg(F.max("_place").alias("_end"), F.max("turn").alias("_turns"))
    if full:
        # The last row's turn and queue; a queue with no row left was asked once more before that.
        end = chosen.select(F.max(F.struct("turn", seq)).alias("e")).first()["e"]
        ends = sizes.join(ends, seq, "left").withColumn("_over", (F.col("_n") + 1 < end[0]) | ((F.col("_n") + 1 == end[0]) & (F.col(seq) < F.lit(end[1]))))
        skipped = placed.where("_is_done").join(ends, seq).where(F.col("_over") | (F.col("_place") < F.col("_end")))
    else:
        skipped = placed.where("_is_done")
    report = chosen.agg(F.count("*").alias("selected")).withColumn("skipped_done", skipped.agg(F.count("*")).scalar()).withColumn("target", F.lit(max(0, target)).cast("long")).withColumn("chunk_full", F.lit(int(full)))
    return chosen.drop("_place", "_is_done"), report


def select_round_robin(queue: DataFrame, done: DataFrame, seq: str, key: str, target: int, *order: str) -> DataFrame:
    """The rows of ``select_chunk``."""
    return select_chunk(queue, done, seq, key, target, *order)[0]


def not_done(items: DataFrame, done: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Items without a finished page; with ``force``, all."""
    return items if force else items.join(done.select(key).distinct(), key, "left_anti")


def first_per_post(images: DataFrame, done: DataFrame, post: str, image: str, limit: int) -> DataFrame:
    """The first image of each post that is not done, of the first posts."""
    left = images.join(done.select(image).distinct(), image, "left_anti")
    return left.groupBy(post).agg(F.min(image).alias(image)).orderBy(post).limit(limit)


def by_priority(rows: DataFrame, rtl: Column, ltr: Column, limit: int) -> DataFrame:
    """Rows that read right to left clearly better first, then by that score, then by image."""
    return rows.orderBy(F.when(rtl > ltr + 1, 0).otherwise(1), -rtl, "image").limit(limit)


def rank_urls(urls: Column, large: str = r"cstp=mx\d{3,}", original: str = r"t39\.(99422|30808-6)") -> Column:
    """Addresses that look large first, then originals, then short ones."""
    keyed = F.transform(urls, lambda u: F.struct(F.when(u.rlike(large), 0).otherwise(1).alias("a"), F.when(u.rlike(original), 0).otherwise(1).alias("b"), F.length(u).alias("c"), u.alias("u")))
    return F.transform(F.array_sort(keyed), lambda x: x["u"])


def numeric_key(text: Column) -> Column:
    """The number that a text is, other texts 0."""
    return F.coalesce(F.when(text.rlike(r"^\d+$"), text.try_cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


def versioned(rows: DataFrame, key: str, order: str) -> DataFrame:
    """rows with ``round``: 1 for each key's earliest, and so on."""
    return rows.withColumn("round", F.row_number().over(Window.partitionBy(key).orderBy(order)))


def cut_at_year(rows: DataFrame, group: str, order: str, year: Column, bottom: int) -> DataFrame:
    """Each group's rows up to and with the first whose year is bottom or earlier."""
    before = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("_cut", F.coalesce(F.max((year <= bottom).cast("int")).over(before), F.lit(0))).where("_cut = 0").drop("_cut")


def skip_streaks(rows: DataFrame, group: str, order: str, seen: Column) -> DataFrame:
    """rows with ``streak``: how many seen rows in a row end here; 0 at a new row."""
    w = Window.partitionBy(group).orderBy(order)
    block = F.sum((~seen).cast("int")).over(w)
    return rows.withColumn("_block", block).withColumn("streak", F.when(seen, F.sum(F.when(seen, 1).otherwise(0)).over(Window.partitionBy(group, "_block").orderBy(order))).otherwise(0)).drop("_block")
