"""The driver's tables in the shapes that the operators read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.base import blank, lines
from ..operators.layout import box
from ..sources.scratch import spread
from .catalogue import table

#: Latin letters as the content script: the driver's tables hold no other.
LETTERS = "A-Za-z"


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as posts; each seventh has no image."""
    image = F.when(F.col("doc_id") % 7 != 0, F.array(F.concat(F.lit("https://img.example.com/"), F.col("doc_id").cast("string"), F.lit(".jpg?s=1"))))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("post_id"), "doc_id", F.col("text").alias("caption"), F.col("source").alias("author"), F.coalesce(image, F.array().cast("array<string>")).alias("image_urls"))


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages with two readings, their paragraphs: b is a with every fifth kind of slip."""
    a = lines(F.col("text"))
    # A text has lines if it is not blank; that is told without cutting it.
    a = spread(table(spark, sf_dir, "documents").select("doc_id", "text").where(~blank(F.col("text")))).select(F.col("doc_id").cast("string").alias("image"), "doc_id", a.alias("a"))
    slip = F.col("doc_id") % 5
    b = F.when(slip == 0, F.col("a")).when(slip == 1, F.transform("a", lambda x: F.concat(F.substring(x, 1, 3), F.substring(x, F.lit(5), F.length(x))))).when(slip == 2, F.reverse("a")).when(slip == 3, F.slice("a", F.lit(1), F.greatest(F.size("a") - 1, F.lit(1)))).otherwise(F.transform("a", lambda x: F.substring(x, 1, F.greatest(F.length(x) / 2, F.lit(1)).cast("int"))))
    return a.withColumn("b", b)


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as the boxes of their order's page."""
    o, p, s = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    xmin, ymin = (p * 37 + s * 11) % 900, (p * 53 + F.col("l_linenumber") * 17) % 900
    kind = F.when(F.col("l_returnflag") == "A", "margin").when(F.col("l_returnflag") == "R", "seal").otherwise("ink_text")
    b = box(F.concat(F.col("l_shipdate").cast("date").cast("string"), F.lit(" "), p.cast("string")), ymin, xmin, ymin + 20 + s % 80, xmin + 10 + p % 60, kind, 1 - F.col("l_discount") * 5)
    return table(spark, sf_dir, "lineitem").select(o.alias("page"), F.col("l_linenumber").alias("line"), b.alias("b"), "l_extendedprice", "l_quantity", "l_discount")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One array of boxes per page, in a total order."""
    return boxes(spark, sf_dir).groupBy("page").agg(F.array_sort(F.collect_list("b")).alias("boxes"))
