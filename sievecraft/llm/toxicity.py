"""Toxicity score: a factorization machine over hashed terms.

A document's terms are its distinct lower-case words and the words' first four,
five and six letters, each hashed to one of ``2**HASH_BITS`` buckets. The machine
scores ``w0 + sum w_i + sum <v_i, v_j>`` over the terms that it keeps, so a pair
of terms (an insult near a group's name) has a weight of its own. A term is kept if it
stands in three labelled documents or more and the chi-square of its 2 x 2 table with
the label is TERM_GAIN or more (chance gives that to one term in ten thousand).

So are two words, however rare, whose meeting tells what neither tells alone. All pairs
of words of the training sample are counted. Where c documents hold both and a share x
of them is toxic, chance gives that share or a farther one with a probability of at most
exp(-c * KL(x, p)); p is the share among all documents, or those with one of the words,
whichever is nearest. With M pairs tested a pair counts if M times twice that is
FALSE_PAIRS or less, so chance adds a pair in one run of twenty. Words too rare to reach this are left out of
the count, which loses nothing. However many terms there are, all are kept.

Training reads at most about ``max_per_class`` labelled documents of each class,
taken by hash of the id; a class's rows are weighted back to its full count.
Scoring reads every document whole.

Defined results: null or empty text has no terms and gets the intercept's
score; very long texts are read whole; repeated rows each get a row; of an id's labels
the highest counts; the learner goes by order of doc_id, so ties change nothing; with no usable label, or labels of one class
only, every score is that class's share (0 without labels). Extra columns of the
input are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, fold, one_label_per_doc, save, share, table

HASH_BITS = 20
WORD = re.compile(r"\w+")
#: Least chi-square of a kept term.
TERM_GAIN = 15
#: Expected pairs of words that are kept by chance.
FALSE_PAIRS = 0.05
#: Words of a block of the count of pairs, and documents that are counted at once.
BLOCK, DOCUMENTS = 1024, 2048
#: Words whose buckets a worker remembers before it starts over.
REMEMBER = 200_000


@dataclass(frozen=True)
class FactorizationMachine:
    """Weights of the kept buckets: ``buckets`` ascending, ``w`` (m), ``v`` (m, k)."""

    bias: float
    buckets: np.ndarray
    w: np.ndarray
    v: np.ndarray

    def logit(self, active: list[int]) -> float:
        if not active:
            return self.bias
        v = self.v[active]
        s = v.sum(0)
        return float(self.bias + self.w[active].sum() + 0.5 * (s @ s - (v * v).sum()))


def word_buckets(word: str) -> tuple[int, ...]:
    n = len(word)
    terms = [f"w:{word}"] + [f"{k}:{word[:k]}" for k in (4, 5, 6) if n >= k]
    return tuple(zlib.crc32(t.encode()) & ((1 << HASH_BITS) - 1) for t in terms)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, tuple[int, ...]] = {}
    for batch in batches:
        out, words = [], []
        for text in batch.column("text").to_pylist():
            seen: set[int] = set()
            own: set[int] = set()
            for word in set(WORD.findall((text or "").lower())):
                if (b := known.get(word)) is None:
                    if len(known) >= REMEMBER:
                        known.clear()
                    b = known[word] = word_buckets(word)
                seen.update(b)
                own.add(b[0])
            out.append(list(seen))
            words.append(list(own))
        lists = [pa.array(x, pa.list_(pa.int32())) for x in (out, words)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), batch.column("y"), batch.column("weight"), *lists], ["doc_id", "row", "y", "weight", "terms", "words"])


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", max_per_class: int = 6000, rank: int = 8, epochs: int = 12, seed: int = 7) -> FactorizationMachine:
    """Learn from ``labels`` (doc_id, label 0/1) and the texts of ``documents`` (doc_id, text).

    The sample's ids are at most ``2 * max_per_class`` in expectation, which bounds
    the broadcast side of the join and what reaches the driver.
    """
    y = one_label_per_doc(labels, label)
    counts = {r["y"]: r["n"] for r in y.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        p = float(next(iter(counts), 0))
        return FactorizationMachine(30.0 if p else -30.0, np.zeros(0, np.int32), np.zeros(0), np.zeros((0, rank)))
    rate = {k: min(1.0, max_per_class / n) for k, n in counts.items()}
    by_class = F.when(F.col("y") == 1, F.lit(rate[1])).otherwise(F.lit(rate[0]))
    chosen = y.where(share(F.col("doc_id"), by_class)).withColumn("weight", 1 / by_class)
    rows = documents.select("doc_id", "text", F.xxhash64("text").alias("row")).join(F.broadcast(chosen), "doc_id")
    terms = save(rows.mapInArrow(_terms, "doc_id long, row long, y int, weight double, terms array<int>, words array<int>"), "toxicity-terms")

    total = terms.agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("y")).alias("pos")).first()
    if not total["n"] or not total["pos"] or total["pos"] >= total["n"]:
        return FactorizationMachine(30.0 if total["pos"] else -30.0, np.zeros(0, np.int32), np.zeros(0), np.zeros((0, rank)))
    # Association of each bucket with the label: the chi-square of its 2 x 2 table.
    p = float(total["pos"] / total["n"])
    per = terms.select(F.explode("terms").alias("bucket"), "y", "weight").groupBy("bucket").agg(F.count("*").alias("df"), F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("y")).alias("pos"))
    gain = (F.col("pos") - F.col("n") * p) ** 2 / (F.col("n") * p * (1 - p))
    kept = {r["bucket"] for r in per.where("df >= 3").where(gain >= TERM_GAIN).select("bucket").collect()}
    kept |= meeting_words(terms)
    buckets = np.array(sorted(kept), np.int32)
    sample = _only(terms, "terms", buckets).to_pandas()
    discard(terms)
    pa.default_memory_pool().release_unused()
    return _descend(sample, buckets, rank, epochs, seed)


def _only(rows: DataFrame, column: str, buckets: np.ndarray) -> pa.Table:
    """(y, weight, terms) of each row, by doc_id and text, with those of the column's buckets that are given: bounded by the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.sort(x[np.isin(x, buckets)]) for x in (np.asarray(t, np.int32) for t in batch.column(column).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), batch.column("y"), batch.column("weight"), pa.array(lists, pa.list_(pa.int32()))], ["doc_id", "row", "y", "weight", "terms"])

    return rows.mapInArrow(run, "doc_id long, row long, y int, weight double, terms array<int>").toArrow().sort_by([("doc_id", "ascending"), ("row", "ascending")])


def divergence(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Kullback-Leibler divergence of a share x from a share p."""
    with np.errstate(divide="ignore", invalid="ignore"):
        one, none = np.where(x > 0, x * np.log(x / p), 0), np.where(x < 1, (1 - x) * np.log((1 - x) / (1 - p)), 0)
    return one + none


def meeting_words(rows: DataFrame) -> set[int]:
    """The words' buckets of all pairs whose meeting tells more about y than either word alone, from exact counts over rows (y, words)."""
    count = rows.select(F.explode("words").alias("w"), "y").groupBy("w").agg(F.count("*").alias("n"), F.sum("y").alias("pos")).toArrow().sort_by("w")
    total = rows.agg(F.count("*").alias("n"), F.sum("y").alias("pos")).first()
    word, n, pos = (count[c].to_numpy() for c in ("w", "n", "pos"))
    p = total["pos"] / total["n"]
    # The rarest word that may count depends on how many pairs are tested, and that on the rarest word.
    least = 2
    while True:
        some = np.flatnonzero(n >= least)
        bar = np.log(2 * max(1.0, len(some) * (len(some) - 1) / 2) / FALSE_PAIRS)
        need = int(np.ceil(bar / -np.log(min(p, 1 - p))))
        if need <= least or len(some) < 2:
            break
        least = min(need, least + max(1, (need - least) // 2))
    if len(some) < 2:
        return set()
    word, share = word[some].astype(np.int32), np.clip(pos[some] / n[some], 0.5 / total["n"], 1 - 0.5 / total["n"])
    table = _only(rows, "words", word)
    order = np.argsort(-table["y"].to_numpy(), kind="stable")
    held, n_pos = table["terms"].take(pa.array(order)).combine_chunks(), int(total["pos"])
    flat, at = np.searchsorted(word, held.flatten().to_numpy()).astype(np.int32), np.concatenate([[0], np.cumsum(held.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    del table, held
    blocks = range(0, len(word), BLOCK)
    pairs = [(a, b) for a in blocks for b in blocks if a <= b]
    spark = rows.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: set[int] = set()
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                found |= _met(flat, at, n_pos, share, p, bar, a, b)
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int32())], ["place"])

    dealt = spark.createDataFrame(pairs, "a int, b int").repartition(len(pairs), "a", "b") if len(pairs) > 1 else spark.createDataFrame(pairs, "a int, b int")
    met = dealt.mapInArrow(run, "place int").distinct().collect()
    return {int(word[r["place"]]) for r in met}


def _met(flat: np.ndarray, at: np.ndarray, n_pos: int, share: np.ndarray, p: float, bar: float, a: int, b: int) -> set[int]:
    """Places of words of the blocks a and b that meet as chance would not let them. Documents with y = 1 come first."""

    def columns(start: int, low: int, high: int) -> np.ndarray:
        x = np.zeros((high - low, min(BLOCK, len(share) - start)), np.float32)
        part = flat[at[low] : at[high]]
        row = np.repeat(np.arange(high - low), np.diff(at[low : high + 1]))
        inside = (part >= start) & (part < start + x.shape[1])
        x[row[inside], part[inside] - start] = 1
        return x

    def counted(low: int, high: int) -> np.ndarray:
        out = np.zeros((min(BLOCK, len(share) - a), min(BLOCK, len(share) - b)), np.float32)
        for start in range(low, high, DOCUMENTS):
            x = columns(a, start, min(high, start + DOCUMENTS))
            out += x.T @ (x if a == b else columns(b, start, min(high, start + DOCUMENTS)))
        return out

    pos, neg = counted(0, n_pos), counted(n_pos, len(at) - 1)
    i, j = np.nonzero(pos + neg >= np.ceil(bar / -np.log(min(p, 1 - p))))
    other = a + i != b + j
    i, j = i[other], j[other]
    c = (pos[i, j] + neg[i, j]).astype(float)
    x = pos[i, j] / c
    told = c * np.minimum(np.minimum(divergence(x, share[a + i]), divergence(x, share[b + j])), divergence(x, np.full(len(x), p)))
    hit = told >= bar
    return set((a + i[hit]).tolist()) | set((b + j[hit]).tolist())


def _descend(sample, buckets: np.ndarray, rank: int, epochs: int, seed: int) -> FactorizationMachine:
    """Adagrad on the weighted logistic loss of the bounded sample."""
    rng = np.random.default_rng(seed)
    y, weight = sample["y"].to_numpy(float), sample["weight"].to_numpy(float)
    weight = weight / weight.mean()
    rows = [np.searchsorted(buckets, np.asarray(t, np.int32)) for t in sample["terms"]]
    size = np.array([len(r) for r in rows])
    p = float(np.clip((weight * y).sum() / weight.sum(), 1e-4, 1 - 1e-4))
    bias, w, v = np.log(p / (1 - p)), np.zeros(len(buckets)), rng.normal(0, 0.02, (len(buckets), rank))
    g0, gw, gv = 1e-6, np.full(len(w), 1e-6), np.full(v.shape, 1e-6)
    rate, decay = 0.15, 1e-4
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for start in range(0, len(order), 256):
            part = order[start : start + 256]
            n = size[part]
            idx = np.concatenate([rows[i] for i in part]) if n.sum() else np.zeros(0, int)
            of = np.repeat(np.arange(len(part)), n)
            s = np.zeros((len(part), rank))
            np.add.at(s, of, v[idx])
            sq = np.bincount(of, (v[idx] ** 2).sum(1), len(part))
            logit = bias + np.bincount(of, w[idx], len(part)) + 0.5 * ((s * s).sum(1) - sq)
            err = weight[part] * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[part]) / len(part)
            d0, dw, dv = err.sum(), np.bincount(idx, err[of], len(w)).astype(float), np.zeros_like(v)
            np.add.at(dv, idx, err[of, None] * (s[of] - v[idx]))
            dw += decay * w / len(part)
            dv += decay * v / len(part)
            g0, gw, gv = g0 + d0 * d0, gw + dw * dw, gv + dv * dv
            bias, w, v = bias - rate * d0 / np.sqrt(g0), w - rate * dw / np.sqrt(gw), v - rate * dv / np.sqrt(gv)
    return FactorizationMachine(float(bias), buckets, w, v)


def _scorer(model: FactorizationMachine):
    """A function from texts to scores."""
    place = {int(b): i for i, b in enumerate(model.buckets)}
    known: dict[str, tuple[int, ...]] = {}

    def scores(texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts))
        for i, text in enumerate(texts):
            active: set[int] = set()
            for word in set(WORD.findall((text or "").lower())):
                if (b := known.get(word)) is None:
                    if len(known) >= REMEMBER:
                        known.clear()
                    b = known[word] = tuple(place[x] for x in word_buckets(word) if x in place)
                if b:
                    active.update(b)
            out[i] = model.logit(sorted(active))
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))

    return scores


def score(documents: DataFrame, model: FactorizationMachine) -> DataFrame:
    """(doc_id, score, predicted) of every row of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scorer(model)
        for batch in batches:
            p = scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double, predicted int")


def keep_accepted(documents: DataFrame, model: FactorizationMachine, threshold: float = 0.5) -> DataFrame:
    """The rows of documents, all columns, whose score is below the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scorer(model)
        for batch in batches:
            yield batch.filter(pa.array(scores(batch.column("text").to_pylist()) < threshold))

    return documents.mapInArrow(run, documents.schema)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = fit(documents, labels.where(~held_out))
    return score(documents, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
