"""Benchmark decontamination: test items inside documents, by MinHash containment.

An item leaks into a document when the document holds at least ``share`` of the
item's distinct 5-word shingles. Items are partitioned by size. An item's signature
is its ``floor((1 - share) * n) + 1`` smallest shingle hashes, so a document that
holds enough of the item holds at least one of them: the search loses nothing, and a
larger item has a longer signature. Documents that are too small for a size partition
leave it at once. Candidates are verified on the shingles' words themselves.

Only SQL expressions and joins; there is no Python on the executors. Items' hashes
are broadcast when they are MAX_BROADCAST at most, else joined by shuffle.

Defined results: null and empty texts hold nothing; items of fewer than five words
have no shingle and never leak; repeated documents give one row for each doc_id and
item_id, with the larger count; empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import save, table
from .quality_rules import let

WORDS = 5
BLANKS = r"[\x20\x09-\x0D]+"
#: Rows of a broadcast side: 2 million hashes with their items are about 50 MB.
MAX_BROADCAST = 2_000_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), BLANKS), "")


def shingles(text: Column, of) -> Column:
    """of(words of the shingle) for each five words in a row; repeats stay."""
    at = lambda w, i: [F.get(w, i + k) for k in range(WORDS)]
    return let(words(text), lambda w: F.when(F.size(w) >= WORDS, F.transform(F.sequence(F.lit(0), F.size(w) - WORDS), lambda i: of(*at(w, i)))))


def bounded(df: DataFrame) -> DataFrame:
    """df, to be broadcast if it is small enough."""
    return F.broadcast(df) if df.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST else df


def leaks(documents: DataFrame, items: DataFrame, share: float = 0.8) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item) of every document and item that it holds."""
    tenths = round(share * 100)
    own = items.select(F.col("item_id"), F.array_distinct(shingles(F.col("text"), lambda *w: F.array_join(F.array(*w), " "))).alias("shingles")).where("shingles is not null")
    own = own.withColumn("n_item", F.size("shingles")).withColumn("size_class", F.floor(F.log2("n_item")).cast("int"))
    hashes = F.array_sort(F.transform("shingles", lambda s: F.xxhash64(s)))
    signature = own.select("item_id", "n_item", "size_class", F.explode(F.slice(hashes, F.lit(1), F.floor(F.col("n_item") * (100 - tenths) / 100).cast("int") + 1)).alias("h"))
    # One row per hash: its items' size partitions, and the items.
    probes = save(signature.groupBy("h").agg(F.min(F.ceil(F.pow(F.lit(2), "size_class") * tenths / 100)).alias("least"), F.collect_set("item_id").alias("item_ids")), "leak-probes")

    found = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = found.withColumn("row", F.xxhash64("text"))
    each = keyed.select("doc_id", "row", shingles(F.col("text"), lambda *w: F.xxhash64(F.concat_ws(" ", *w))).alias("h")).where("h is not null").select("doc_id", "row", F.size("h").alias("size"), F.explode("h").alias("h"))
    hit = each.join(bounded(probes), "h").where("size >= least").select("doc_id", "row", F.explode("item_ids").alias("item_id"))
    candidates = save(hit.distinct(), "leak-candidates")

    texts = keyed.join(bounded(candidates.groupBy("doc_id", "row").agg(F.collect_set("item_id").alias("item_ids")).withColumnRenamed("doc_id", "own")), ["row"]).where("doc_id <=> own").drop("own")
    pairs = texts.select("doc_id", F.array_distinct(shingles(F.col("text"), lambda *w: F.array_join(F.array(*w), " "))).alias("held"), F.explode("item_ids").alias("item_id")).join(bounded(own), "item_id")
    counted = pairs.select("doc_id", "item_id", F.size(F.array_intersect("held", "shingles")).cast("long").alias("n_shared"), F.col("n_item").cast("long").alias("n_item"))
    return counted.where(F.col("n_shared") * 100 >= F.col("n_item") * tenths).groupBy("doc_id", "item_id").agg(F.max("n_shared").alias("n_shared"), F.max("n_item").alias("n_item"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SHINGLES = """
  select {id}, array_to_string(w[i:i + 4], ' ') as s
  from (select {id}, regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+') as w from {table}) t,
       unnest(range(1, cast(len(w) as bigint) - 3)) as r(i)
"""

OP3_SQL = f"""
with d as (select distinct * from ({_SHINGLES.format(id="doc_id", table="documents")})),
     b as (select distinct * from ({_SHINGLES.format(id="item_id", table="benchmark")})),
     n as (select item_id, count(*) as n_item from b group by item_id)
select d.doc_id, b.item_id, count(*) as n_shared, any_value(n.n_item) as n_item
from d join b using (s) join n using (item_id)
group by d.doc_id, b.item_id
having count(*) * 100 >= any_value(n.n_item) * 80
"""
