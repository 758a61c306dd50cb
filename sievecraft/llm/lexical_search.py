"""Ranked lexical search by hashed max-sketches.

A document's index row holds a sketch: each distinct term is hashed to one of a power
of two of coordinates, eight a term or more, and a coordinate keeps the greatest count
of its terms. A term's impact rises with its count, so at a coordinate the impact of the
greatest count is the greatest impact, whatever the corpus totals are: they may come later.
The row also holds its distinct terms with their counts, for exact scores.

A query's upper bound for a document sums, over its terms, weight times impact at the
term's coordinate. Bounds of a block of queries are looked up for many documents at
once. In a task, each query goes through the documents by descending bound and scores
them exactly until the bounds fall below its threshold: the score of its k-th best so
far. Thresholds begin at those of a lead, a fixed share of the index that is searched
first, so that the tasks of a large index send little more than the answer. Nothing that
may be among the k best is passed by: bounds equal to the threshold are scored too.

Terms are maximal runs of letters A-Z, digits and characters beyond ASCII; only A-Z are
lower-cased. Queries come in blocks of at most BLOCK items, which bound what a task gets.

Defined results: null and empty texts, and texts without terms, hold no term and are
never found; they do not count in N. Rows of one item_id (null is one too) are one item with the terms
of all; an item without terms finds nothing. Repeated documents are ranked each;
equal scores by ascending doc_id, a null one last, rows that agree in that too are
interchangeable. Very long texts are read whole; their sketch grows with their terms.
Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, save, steps, table

#: Documents that an item gets.
TOP = 50
#: Coordinates a distinct term, at least; and those of the smallest sketch.
SPREAD, LEAST = 8, 64
#: Counts of this or more are kept as this, and bounded by the limit of impacts.
FULL = 255
#: Queries of a block.
BLOCK = 2048
#: One in so many documents leads.
LEAD = 64
#: Bytes of text that one step indexes, index rows that one step searches, and bounds' parts that it holds at once.
STEP_BYTES, STEP_ROWS, STEP = 1 << 20, 1024, 1 << 19
SCALE, LENGTH, HALF = 1_000_000_000, 20, 50

#: Letters to lower case, what is no part of a term to blanks; bytes above 127 are parts of terms.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(raw: bytes) -> list[bytes]:
    return raw.translate(_TERM_BYTES).split()


def coordinates(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, found), np.uint32, len(found))


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (step for whole in batches for step in steps(whole, limit=STEP_BYTES)):
        size, sketches, words, counts = [], [], [], []
        for raw in batch.column("text").to_pylist():
            held = Counter(terms(raw or b""))
            tf = np.fromiter(held.values(), np.int64, len(held))
            sketch = np.zeros(max(LEAST, 1 << (SPREAD * len(held) - 1).bit_length()) if held else 0, np.uint8)
            if held:
                np.maximum.at(sketch, coordinates(list(held)) & np.uint32(len(sketch) - 1), np.minimum(tf, FULL).astype(np.uint8))
            size.append(int(tf.sum()))
            sketches.append(sketch.tobytes())
            words.append(b" ".join(held))
            counts.append(tf.astype(np.int32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(sketches, pa.binary()), pa.array(words, pa.binary()), pa.array(counts, pa.binary())], ["doc_id", "n", "sketch", "terms", "counts"])


@dataclass(frozen=True)
class Index:
    """lead and rest: (doc_id, n, sketch, terms, counts), one row a document with terms; their number and all terms with repeats."""

    lead: DataFrame
    rest: DataFrame
    documents: int
    length: int

    def rows(self) -> DataFrame:
        return self.lead.unionByName(self.rest)


def build(documents: DataFrame) -> Index:
    """The index of documents (doc_id, text)."""
    found = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    rows = save(found.mapInArrow(_index, "doc_id long, n long, sketch binary, terms binary, counts binary").where("n > 0").withColumn("leads", F.pmod(F.xxhash64("terms", "n"), F.lit(LEAD)) == 0), "search-index", by=("leads",), compression="zstd")
    total = rows.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    return Index(rows.where("leads").drop("leads"), rows.where("not leads").drop("leads"), total["documents"], total["length"])


def query_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): one row an item, its distinct terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array([list(set(terms(raw or b""))) for raw in batch.column("text").to_pylist()], pa.list_(pa.binary()))], ["item_id", "terms"])

    found = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(run, "item_id long, terms array<binary>")
    return found.select("item_id", F.explode("terms").alias("term")).groupBy("item_id").agg(F.array_sort(F.collect_set("term")).alias("terms"))


@dataclass(frozen=True)
class Queries:
    """A block of queries: the block's terms with their weights, and the terms' places query by query."""

    ids: list[int | None]
    vocabulary: list[bytes]
    weight: np.ndarray
    places: np.ndarray
    start: np.ndarray


def _counted(vocabulary: frozenset[bytes]):
    """(term, df) of the vocabulary in a task's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter = Counter()
        for batch in batches:
            for held in batch.column("terms").to_pylist():
                df.update(vocabulary.intersection(held.split(b" ")))
        yield pa.RecordBatch.from_arrays([pa.array(list(df), pa.binary()), pa.array(list(df.values()), pa.int64())], ["term", "df"])

    return run


def weigh(index: Index, block: list[tuple[int | None, list[bytes]]]) -> Queries:
    """The block's terms weighed by how many documents hold them."""
    vocabulary = sorted({t for _, held in block for t in held})
    at = {t: i for i, t in enumerate(vocabulary)}
    df = {bytes(r["term"]): r["df"] for r in index.rows().select("terms").mapInArrow(_counted(frozenset(vocabulary)), "term binary, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()}
    weight = np.array([math.floor(1000 * math.log((2 * index.documents + 2) / (2 * df.get(t, 0) + 1))) for t in vocabulary], np.int64)
    sizes = [len(held) for _, held in block]
    return Queries([i for i, _ in block], vocabulary, weight, np.array([at[t] for _, held in block for t in held], np.int64), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (SCALE * tf) // (1000 * tf + LENGTH * m)


class Best:
    """A query's best documents of a task: (score, doc_id), at most TOP of them, and the score to reach."""

    def __init__(self, floor: int):
        self.floor, self.rows = floor, []

    def add(self, score: int, doc_id: int | None) -> None:
        if score >= self.floor:
            self.rows.append((-score, doc_id is None, doc_id or 0))
            if len(self.rows) >= 2 * TOP:
                self.cut()
            elif len(self.rows) == TOP:
                self.floor = max(self.floor, -max(self.rows)[0])

    def cut(self) -> list[tuple]:
        self.rows = sorted(self.rows)[:TOP]
        if len(self.rows) == TOP:
            self.floor = max(self.floor, -self.rows[-1][0])
        return self.rows


def _search(queries: Queries, documents: int, length: int, floors: list[int]):
    """A task's best documents: (item_id, doc_id, score)."""
    hashes = coordinates(queries.vocabulary)
    at = {t: i for i, t in enumerate(queries.vocabulary)}
    weights = queries.weight[queries.places]
    starts = queries.start[:-1]

    def bounds(sketches: list[bytes], m: np.ndarray) -> np.ndarray:
        """(document, query) of documents whose sketches have one size."""
        flat = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)
        tf = flat[:, hashes & np.uint32(flat.shape[1] - 1)].astype(np.int64)
        most = np.where(tf == FULL, SCALE // 1000, impact(tf, m[:, None]))
        return np.add.reduceat(most[:, queries.places] * weights, starts, 1)

    def held(words: bytes, counts: bytes, m: int) -> np.ndarray:
        """Weight times impact of the block's terms in a document."""
        here = [(at[t], k) for k, t in enumerate(words.split(b" ")) if t in at]
        out = np.zeros(len(at), np.int64)
        if here:
            place, k = np.array(here).T
            out[place] = queries.weight[place] * impact(np.frombuffer(counts, np.int32)[k].astype(np.int64), np.int64(m))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(f) for f in floors]
        for batch in (whole.slice(k, STEP_ROWS) for whole in batches for k in range(0, whole.num_rows, STEP_ROWS)):
            ids, words, counts, sketches = (batch.column(c).to_pylist() for c in ("doc_id", "terms", "counts", "sketch"))
            m = 100 - HALF + (HALF * batch.column("n").to_numpy() * documents) // length
            size = np.array([len(s) for s in sketches])
            for s in np.unique(size).tolist():
                same = np.flatnonzero(size == s)
                step = max(1, STEP // max(s, len(queries.places)))
                for rows in (same[i : i + step] for i in range(0, len(same), step)):
                    upper = bounds([sketches[i] for i in rows], m[rows])
                    exact: dict[int, np.ndarray] = {}
                    for q in np.flatnonzero(upper.max(0) >= [x.floor for x in best]).tolist():
                        mine = best[q]
                        may = np.flatnonzero(upper[:, q] >= mine.floor)
                        for k in may[np.argsort(-upper[may, q], kind="stable")].tolist():
                            if upper[k, q] < mine.floor:
                                break
                            if k not in exact:
                                exact[k] = held(words[rows[k]], counts[rows[k]], m[rows[k]])
                            mine.add(int(exact[k][queries.places[queries.start[q] : queries.start[q + 1]]].sum()), ids[rows[k]])
        rows = [(queries.ids[q], None if null else i, -score) for q, mine in enumerate(best) for score, null, i in mine.cut()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], ["item_id", "doc_id", "score"])

    return run


def _first(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").isNull(), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(index: Index, items: DataFrame) -> DataFrame:
    """(item_id, rank, doc_id, score) of the TOP best documents of each item (item_id, text)."""
    spark = items.sparkSession
    asked = query_terms(items)
    blocks = max(1, math.ceil(asked.count() * 1.1 / BLOCK))
    asked = save(asked.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")), "search-queries")
    schema = "item_id long, doc_id long, score long"
    out = spark.createDataFrame([], "item_id long, doc_id long, score long, rank int")
    for b in range(blocks):
        block = [(r["item_id"], [bytes(t) for t in r["terms"]]) for r in asked.where(F.col("block") == b).orderBy("item_id").collect()]
        if not block or not index.documents:
            continue
        queries = weigh(index, block)
        lead = save(_first(index.lead.mapInArrow(_search(queries, index.documents, index.length, [1] * len(block)), schema), TOP), "search-lead")
        last = {r["item_id"]: r["score"] for r in lead.where(F.col("rank") == TOP).collect()}
        found = index.rest.mapInArrow(_search(queries, index.documents, index.length, [last.get(i, 1) for i in queries.ids]), schema)
        out = out.unionByName(save(_first(found.unionByName(lead.select("item_id", "doc_id", "score")), TOP), "search-found"))
        discard(lead)
    discard(asked)
    return out.select("item_id", "rank", "doc_id", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build(table(spark, sf_dir, "documents"))
    found = search(index, table(spark, sf_dir, "benchmark"))
    discard(index.rows())
    return found


_TERMS = """
  select {id}, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as t
  from {table}
"""

OP11_SQL = f"""
with rows_of as (select row_number() over () as r, doc_id, text from documents),
     d as (select r, t, count(*) as tf from ({_TERMS.format(id="r", table="rows_of")}) group by r, t),
     n as (select r, cast(sum(tf) as bigint) as n from d group by r),
     c as (select cast(count(*) as bigint) as n_docs, cast(sum(n) as bigint) as l from n),
     q as (select distinct * from ({_TERMS.format(id="item_id", table="benchmark")})),
     w as (select t, cast(floor(1000 * ln((2 * any_value(c.n_docs) + 2) / (2 * count(*) + 1))) as bigint) as w from d, c where t in (select t from q) group by t),
     s as (
       select q.item_id, d.r, cast(sum(w.w * ((1000000000 * d.tf) // (1000 * d.tf + 20 * (100 - 50 + (50 * n.n * c.n_docs) // c.l)))) as bigint) as score
       from q join w using (t) join d using (t) join n using (r), c
       group by q.item_id, d.r
     )
select item_id, cast(rank as int) as rank, doc_id, score
from (select s.*, rows_of.doc_id, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank from s join rows_of using (r) where score > 0)
where rank <= {TOP}
"""
