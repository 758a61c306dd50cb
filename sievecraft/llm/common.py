"""Helpers shared by the operators of this subpackage.

Lineage is cut with ``save``: a table below ``spark.checkpoint.dir``, the folder that
the driver and all executors share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import save, shared_dir

__all__ = ["discard", "flat", "fold", "one_label_per_doc", "save", "share", "shared_dir", "steps", "table"]

#: Bytes of text that one vectorised step works on; a longer text is a step of its own.
STEP_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def discard(*tables: DataFrame) -> None:
    """Delete saved tables that nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0]).getParent() if df.inputFiles() else None
        if path is not None and shared_dir(df.sparkSession).rsplit("/", 1)[-1] in path.toString():
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, mod n; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))


def share(doc_id: Column, rate: Column | float) -> Column:
    """True for about the given share of ids, by hash: the same ids in each run."""
    return F.pmod(F.xxhash64(doc_id, F.lit("share")), F.lit(1 << 30)) < F.lit(1 << 30) * rate


def one_label_per_doc(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, y): repeated ids take their highest label; null ids and labels go."""
    return labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1)).groupBy("doc_id").agg(F.max(column).cast("int").alias("y"))


def steps(batch: pa.RecordBatch, column: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``limit`` bytes of text each."""
    if batch.num_rows == 0:
        return
    start, held = 0, 0
    for i, size in enumerate(_sizes(batch.column(column)).tolist()):
        if i > start and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    yield batch.slice(start)


def _sizes(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row and the offsets of each; null counts as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string()) if pa.types.is_string(texts.type) else pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(data) else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]
