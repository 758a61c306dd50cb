"""Language identification: nearest of several clustered centroids per language.

A text becomes a vector of hashed byte n-grams (n = 1, 2, 3) of its letters, with
logarithmic term frequency times inverse document frequency, scaled to length 1.
Each learned language has a few centroids (spherical k-means); a text gets the
language of the centroid with the highest cosine. A text that is further from its
centroid than nearly all of that centroid's own members is flagged as rejected.

Document frequencies are counted over all training documents. The clustering reads
about ``max_per_lang`` documents of each language, taken by hash of the id, which
bounds the group that one task clusters.

Defined results: null text, or text without a letter, gives `und` with score 0, as
does any text when nothing was learned; a letter is a character of Unicode's categories L,
so digits, Roman numerals and signs are none; repeated rows each get a row; of centroids
with one cosine the first in order of language wins; very long texts are read whole, in
steps of their own; documents of null language are not learned from. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import flat, fold, share, steps, table

BUCKETS = 4096
ROWS = 512
LETTER = regex.compile(r"\p{L}")
#: Letters in lower case and all bytes of other scripts stay, the rest is a blank.
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint32)


def counts(texts: pa.Array) -> np.ndarray:
    """(rows, BUCKETS) counts of the texts' hashed n-grams; none spans two texts."""
    raw, offsets = flat(texts)
    rows = len(texts)
    c = _FOLD[raw]
    of = np.repeat(np.arange(rows, dtype=np.int64), np.diff(offsets))
    out = np.zeros(rows * BUCKETS)
    gram = np.zeros(len(c), np.uint32)
    for n in (1, 2, 3):
        if len(c) < n:
            break
        m = len(c) - n + 1
        gram = gram[:m] * np.uint32(257) + c[n - 1 :]
        mixed = gram * np.uint32(0x9E3779B1)
        slot = (mixed >> np.uint32(20)).astype(np.int64)
        same = of[:m] == of[n - 1 :]
        out += np.bincount((of[:m] * BUCKETS + slot)[same], minlength=rows * BUCKETS)
    return out.reshape(rows, BUCKETS)


def vectors(texts: pa.Array, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts(texts)) * idf
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return (x / np.where(norm == 0, 1, norm)).astype(np.float32)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in steps(batch):
            for start in range(0, part.num_rows, ROWS):
                yield part.slice(start, ROWS)


@dataclass(frozen=True)
class Centroids:
    idf: np.ndarray
    langs: tuple[str, ...]
    centroid: np.ndarray  # one row each, of length 1
    reach: np.ndarray  # lowest cosine of a member that is not rejected


def _cluster(x: np.ndarray, k: int, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart first centres; unit centroids and each row's centroid."""
    first = x.mean(0)
    chosen = [int(np.argmax(x @ first))]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(np.argmin((x @ x[chosen].T).max(1))))
    c = x[chosen]
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        c = np.stack([x[own == j].sum(0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.sqrt((c * c).sum(1, keepdims=True)), 1e-12)
    return c, (x @ c.T).argmax(1)


def fit(documents: DataFrame, per_lang: int = 4, max_per_lang: int = 1200, reject_share: float = 0.005) -> Centroids:
    """Learn from (doc_id, text, lang) rows; rows of null lang or text are left out."""
    rows = documents.select("doc_id", "text", "lang").where("lang is not null and text is not null")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df, langs = 0, np.zeros(BUCKETS), {}
        for part in _parts(batches):
            df += (counts(part.column("text")) > 0).sum(0)
            n += part.num_rows
            for lang in part.column("lang").to_pylist():
                langs[lang] = langs.get(lang, 0) + 1
        hit = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"kind": pa.array(["df"] * len(hit) + ["lang"] * len(langs)), "key": pa.array([str(i) for i in hit] + list(langs), pa.string()), "n": pa.array([*df[hit].astype(np.int64).tolist(), *langs.values()], pa.int64())})

    found = rows.mapInArrow(frequencies, "kind string, key string, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")).collect()
    per = {r["key"]: r["n"] for r in found if r["kind"] == "lang"}
    total, df = sum(per.values()), np.zeros(BUCKETS)
    for r in found:
        if r["kind"] == "df":
            df[int(r["key"])] = r["n"]
    idf = np.log((1 + total) / (1 + df)) + 0.1
    if not per:
        return Centroids(idf, (), np.zeros((0, BUCKETS), np.float32), np.zeros(0))

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            at, value = [], []
            for x in vectors(part.column("text"), idf):
                hit = np.flatnonzero(x)
                at.append(hit.astype(np.int32))
                value.append(x[hit])
            yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array(at, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32()))], ["lang", "at", "value"])

    def centroids(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.zeros((len(pdf), BUCKETS), np.float32)
        for i, (at, value) in enumerate(zip(pdf["at"], pdf["value"], strict=True)):
            x[i, at] = value
        x = x[np.lexsort(x[:, :64].T)]  # the same order whatever the partitions
        c, own = _cluster(x, per_lang)
        cosine = (x * c[own]).sum(1)
        reach = [float(np.quantile(cosine[own == j], reject_share)) if (own == j).any() else 1.0 for j in range(len(c))]
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centroid": [r.tolist() for r in c], "reach": reach})

    rates = F.create_map(*[F.lit(v) for k, n in per.items() for v in (k, min(1.0, max_per_lang / n))])
    sample = rows.where(share(F.col("doc_id"), F.element_at(rates, F.col("lang")))).mapInArrow(sparse, "lang string, at array<int>, value array<float>")
    model = sample.groupBy("lang").applyInPandas(centroids, "lang string, centroid array<float>, reach double").collect()
    model.sort(key=lambda r: (r["lang"], r["centroid"]))
    return Centroids(idf, tuple(r["lang"] for r in model), np.array([r["centroid"] for r in model], np.float32).reshape(-1, BUCKETS), np.array([r["reach"] for r in model]))


def predict(documents: DataFrame, model: Centroids, reject: bool = True) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row; with reject, rejected texts are `und`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            texts = part.column("text")
            letters = np.array([t is not None and LETTER.search(t) is not None for t in texts.to_pylist()], bool)
            pred, score, far = np.full(len(letters), "und", object), np.zeros(len(letters)), np.zeros(len(letters), bool)
            if model.langs and letters.any():
                cosine = vectors(texts, model.idf) @ model.centroid.T
                best = cosine.argmax(1)
                top = cosine[np.arange(len(best)), best].astype(float)
                far = letters & (top < model.reach[best])
                known = letters & ~far if reject else letters
                pred[known] = np.array(model.langs, object)[best[known]]
                score = np.where(letters, np.clip(top, 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(pred, pa.string()), pa.array(score), pa.array(far)], ["doc_id", "lang_pred", "score", "rejected"])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = fit(documents.where(~held_out))
    return predict(documents, model, reject=False).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
