"""Token counts of documents in flat token files that have no index.

A file is a run of unsigned 16-bit ids in which an end-of-document id closes each
document. Files come as blocks of fixed length that know nothing of documents. Each
block is searched for the end id in one vectorised pass; a prefix scan over the
blocks' totals (tokens, ends, place of the last end) then stitches documents that
cross block and file borders. Only separators' places leave a block, never its ids.

Defined results: null and empty texts count 1, their end id; ids after a file set's
last end id make one more document with ``ended`` false; repeated rows are separate
documents; no blocks give no rows.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_dir, table

END = 50256
#: Ids in a block.
BLOCK = 1 << 16
_loaded: dict = {}


def rank_file(path: str) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}


def encoding(path: str):
    """A tiktoken encoding of the rank file, one per worker process."""
    if path not in _loaded:
        import tiktoken

        _loaded[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=rank_file(path), special_tokens={})
    return _loaded[path]


def write_flat(documents: DataFrame, ranks: str, end_id: int = END, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Encode documents in the order they are stored.

    Returns the blocks (file, block, payload) and, apart from them, which document
    is the n-th of each file (file, nth, doc_id); the counts do not use the latter.
    """
    spark = documents.sparkSession
    schema = "kind string, file int, nth long, doc_id long, payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, enc, nth, n_block, held, n_held = TaskContext.get().partitionId(), encoding(ranks), 0, 0, [], 0

        def rows(kind: str, first: int, docs: list, payloads: list) -> pa.RecordBatch:
            n = len(docs)
            return pa.RecordBatch.from_arrays([pa.array([kind] * n), pa.array([file] * n, pa.int32()), pa.array(range(first, first + n), pa.int64()), pa.array(docs, pa.int64()), pa.array(payloads, pa.binary())], ["kind", "file", "nth", "doc_id", "payload"])

        for batch in batches:
            for text in batch.column("text"):
                ids = enc.encode_ordinary(text.as_py() or "")
                held.append(np.array([*ids, end_id], "<u2"))
                n_held += len(held[-1])
                if n_held >= block:
                    flat = np.concatenate(held)
                    whole = len(flat) // block
                    for i in range(whole):
                        yield rows("block", n_block + i, [None], [flat[i * block : (i + 1) * block].tobytes()])
                    n_block, held = n_block + whole, [flat[whole * block :]]
                    n_held = len(held[0])
            docs = batch.column("doc_id").to_pylist()
            yield rows("doc", nth, docs, [None] * len(docs))
            nth += len(docs)
        if n_held:
            yield rows("block", n_block, [None], [np.concatenate(held).tobytes()])

    path = f"{shared_dir(spark)}/flat-tokens-{uuid.uuid4().hex[:12]}"
    documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema).write.option("compression", "zstd").partitionBy("kind").parquet(path)
    both = spark.read.schema(schema).parquet(path)
    return both.where("kind = 'block'").select("file", F.col("nth").alias("block"), "payload"), both.where("kind = 'doc'").select("file", "nth", "doc_id")


def separators(blocks: DataFrame, end_id: int = END) -> DataFrame:
    """(file, block, n, ends): each block's length and the places in it of the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ends = [], []
            for payload in batch.column("payload"):
                ids = np.frombuffer(payload.as_py(), "<u2")
                n.append(len(ids))
                ends.append(np.flatnonzero(ids == end_id))
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("block"), pa.array(n, pa.int64()), pa.array(ends, pa.list_(pa.int64()))], ["file", "block", "n", "ends"])

    return blocks.mapInArrow(run, "file int, block long, n long, ends array<long>")


def token_counts(blocks: DataFrame, end_id: int = END) -> DataFrame:
    """(file, nth, doc, start, n_tokens, ended) of every document.

    ``doc`` numbers documents over all files in order and ``nth`` the ends within the
    file where the document ends; ``start`` counts the ids before it.
    """
    found = separators(blocks, end_id)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.when(F.size("ends") > 0, F.col("at") + F.element_at("ends", -1) + 1)
    within = found.withColumn("at", F.coalesce(F.sum("n").over(earlier), F.lit(0))).withColumn("nth", F.coalesce(F.sum(F.size("ends")).over(earlier), F.lit(0)).cast("long")).withColumn("last", last)
    within = within.withColumn("open", F.max("last").over(earlier))  # where the open document began, null: in an earlier file

    # One row per file; its scan is over files, not blocks.
    files = within.groupBy("file").agg(F.sum("n").alias("n"), F.sum(F.size("ends")).cast("long").alias("docs"), F.max("last").alias("last"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("doc_base", F.coalesce(F.sum("docs").over(before), F.lit(0)))
    files = files.withColumn("began", F.coalesce(F.max(F.col("base") + F.col("last")).over(before), F.lit(0)))

    joined = within.join(files.select("file", "base", "doc_base", "began"), "file")
    each = joined.select("file", "at", "nth", "base", "doc_base", F.coalesce(F.col("base") + F.col("open"), "began").alias("began"), "ends", F.posexplode("ends").alias("k", "end"))
    start = F.when(F.col("k") == 0, F.col("began")).otherwise(F.col("base") + F.col("at") + F.element_at("ends", F.col("k")) + 1)
    nth = F.col("nth") + F.col("k")
    ended = each.select("file", nth.alias("nth"), (F.col("doc_base") + nth).alias("doc"), start.alias("start"), (F.col("base") + F.col("at") + F.col("end") + 1 - start).alias("n_tokens"), F.lit(True).alias("ended"))
    tail = files.agg(F.max("file").alias("file"), F.max(F.col("base") + F.col("n")).alias("all"), F.sum("docs").alias("doc"), F.coalesce(F.max(F.col("base") + F.col("last")), F.lit(0)).alias("start"))
    tail = tail.where("all > start").select("file", F.lit(None).cast("long").alias("nth"), "doc", "start", (F.col("all") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended"))
    return ended.unionByName(tail)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, doc, start, n_tokens): the documents in the order of their files."""
    blocks, docs = write_flat(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return token_counts(blocks).join(docs, ["file", "nth"]).select("doc_id", "doc", "start", "n_tokens")
