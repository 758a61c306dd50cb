"""Mixing sources to target weights by systematic sampling.

A source's target is its weight's part of all words, at most ``most`` times its own
words; what a source cannot take is shared out by weight among the others until none is
above. Every document of a source is expected ``target / source_size`` times. The
documents of a source stand in a row, by size; their expected copies are summed along
it, one random offset is added for the whole source, and a document is taken once for
each whole number that its own step passes. So a document is taken as often as
expected, rounded up or down, and never more than ``most`` times; and as neighbours have
like sizes, the words taken differ from the target by less than twice the source's
longest document.

SQL functions only. The place in the row comes from a range sort over all sources and
the counts of its partitions (``queues.global_index``), so a source of any size is many
tasks. All counts are whole numbers (decimals of 38 digits), so no rounding adds up.

Defined results: null and empty texts have size 0, take part in their source's row and
take no words; a null source is a source of its own, the last; a source without words
has target 0; rows of one source, size and doc_id are interchangeable, a null doc_id
stands first; repeated rows count each; very long texts are counted whole; an empty table
gives no rows. The offset is a hash of the seed and the source's name, so reruns agree.
Extra columns are ignored, or carried if named in ``keep``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.queues import global_index
from .common import discard, save, table
from .decontamination import bounded

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: A source's target is at most so many times its words.
MOST = 3
#: Bits of an offset.
OFFSET_BITS = 32
_WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(_WORD)).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 0) -> DataFrame:
    """By source (``absent``, ``name``): source_size, target, and the step ``num / den`` and offset of its row.

    The level at which no target is above its limit is found by whole sums over the
    sources, one small job a round; a round limits at least one more source.
    """
    per = sized.groupBy("absent", "name").agg(F.sum("size").alias("source_size"))
    placed, _ = global_index(per, "absent", "name")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("idx") % len(weights)).cast("int")).cast("decimal(20,0)")
    sources = save(placed.select("absent", "name", "source_size", weight.alias("w"), (F.col("source_size").cast("decimal(20,0)") * most).cast("decimal(20,0)").alias("most")), "mix-sources")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).cast("decimal(20,0)")).first()[0]
    # Share a weight of 1 gets: left / free, of those that are not at their limit.
    left, free, n = total, sources.agg(F.sum("w")).first()[0] or 0, 0
    at_limit = lambda: F.col("most") * F.lit(int(free)).cast("decimal(18,0)") <= F.col("w") * F.lit(int(left)).cast("decimal(20,0)")
    while free:
        got = sources.where(at_limit()).agg(F.count("*").alias("n"), F.coalesce(F.sum("most"), F.lit(0)).alias("most"), F.coalesce(F.sum("w"), F.lit(0)).alias("w")).first()
        if got["n"] == n:
            break
        n, left, free = got["n"], total - got["most"], sources.agg(F.sum("w")).first()[0] - got["w"]
    big = lambda c: c.cast("decimal(20,0)")
    limited = at_limit() if free else F.lit(True)
    share = F.col("w") * big(F.lit(int(left)))
    num = F.when(limited | (F.col("source_size") == 0), big(F.lit(most))).otherwise(big(share))
    den = F.when(limited | (F.col("source_size") == 0), big(F.lit(1))).otherwise(big(F.col("source_size") * F.lit(int(free or 1)).cast("decimal(18,0)")))
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("absent").cast("string"), F.col("name")).cast("binary")), 1, OFFSET_BITS // 4)
    part = F.conv(digits, 16, 10).cast("decimal(10,0)")
    target = F.when(limited, F.col("most").cast("double")).otherwise(share.cast("double") / F.lit(float(free or 1)))
    out = sources.select("absent", "name", "source_size", target.alias("target"), num.alias("num"), den.alias("den"), part.alias("part"))
    return out.withColumn("offset", F.expr(f"cast(den * part / {1 << OFFSET_BITS}BD as decimal(38,6))")).withColumn("offset", F.floor("offset").cast("decimal(20,0)")).drop("part")


def plan(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 0, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *keep, size, source_size, target, copies, taken) of every row of documents."""
    more = tuple(c for c in keep if c != "doc_id")
    source = F.col("source").cast("string")
    sized = documents.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).alias(f"kept_{c}") for c in more], source.isNull().alias("absent"), F.coalesce(source, F.lit("")).alias("name"), size_of(F.col("text")).alias("size"))
    sized = save(sized, "mix-sizes")
    goals = save(targets(sized, weights, most, seed), "mix-targets")
    # The last key is there to split rows that are alike in all others.
    placed, _ = global_index(sized.withColumn("tie", F.monotonically_increasing_id()), "absent", "name", "size", "doc_id", "tie")
    goals = goals.join(placed.groupBy("absent", "name").agg(F.min("idx").alias("first")), ["absent", "name"])
    rows = placed.join(bounded(goals), ["absent", "name"]).withColumn("i", (F.col("idx") - F.col("first")).cast("decimal(18,0)"))
    passed = F.expr("(((i + 1) * num + offset) div den) - ((i * num + offset) div den)").cast("long")
    rows = rows.withColumn("copies", F.when(F.col("target") > 0, passed).otherwise(F.lit(0)).cast("long"))
    discard(sized)
    return rows.select("doc_id", *[F.col(f"kept_{c}").alias(c) for c in more], "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 0) -> DataFrame:
    """The mixed corpus: the rows of documents, each as often as it is taken."""
    chosen = plan(documents, weights, most, seed, keep=tuple(documents.columns)).where("copies > 0")
    return chosen.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*documents.columns, "copy")


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


OP12_SQL = """
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as hugeint) as size from documents
), s as (
  select source, sum(size) as source_size, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as w
  from d group by source
), f as (
  select *, 3 * source_size as most, sum(source_size) over () as total,
    coalesce(sum(3 * source_size) over before, 0) as below,
    sum(w) over () - coalesce(sum(w) over before, 0) as free_from
  from s window before as (order by 30 * source_size // w, source nulls last rows between unbounded preceding and 1 preceding)
), c as (
  select *, w * (total - below) >= most * free_from as limited from f
), g as (
  select *, max(total) over () - coalesce(sum(most) filter (limited) over (), 0) as left_over, sum(w) filter (not limited) over () as free from c
), t as (
  select source, source_size,
    case when limited then cast(most as double) else cast(w * left_over as double) / cast(free as double) end as target,
    cast(case when limited or source_size = 0 then 3 else w * left_over end as hugeint) as num,
    cast(case when limited or source_size = 0 then 1 else source_size * free end as hugeint) as den,
    cast(('0x' || substr(md5('0|' || case when source is null then 'true' else 'false' end || '|' || coalesce(source, '')), 1, 8)) as hugeint) as part
  from g
), r as (
  select d.doc_id, d.size, t.*, den * part // 4294967296 as u,
    cast(row_number() over (partition by d.source order by d.size, d.doc_id nulls first) - 1 as hugeint) as i
  from d join t on d.source is not distinct from t.source
), x as (
  select *, case when target > 0 then ((i + 1) * num + u) // den - (i * num + u) // den else 0 end as copies from r
)
select doc_id, cast(size as bigint) as size, cast(source_size as bigint) as source_size, target,
  cast(copies * size as bigint) as taken, cast(copies as bigint) as copies
from x
"""
