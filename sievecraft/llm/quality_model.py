"""Quality score: regularised quadratic discriminant over document statistics.

Each text becomes a vector of transformed statistics (logarithms of counts and
ratios). Each class has a Gaussian whose covariance is shrunk first towards the
pooled covariance and then towards its diagonal; a document's score is the logistic
of the difference of the two log densities plus the log prior. The densities use
Cholesky factors that are computed once and sent with the task.

The class means and covariances are sums over all labelled training documents,
made by the executors; the driver gets one sum per class.

Defined results: null and empty texts have the statistics of an empty text;
repeated rows each get a row; with no label, or one class only, the score is that
class (0.5 without labels). Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, one_label_per_doc, save, table

STATS = ("bytes", "words", "word_len", "distinct", "symbols", "punct", "upper", "digits", "space", "lines", "dup_lines", "dup_triples", "bars", "bangs", "wide", "longest")
_CLASSES = {k: bytes(v, "ascii") for k, v in {"symbols": "#*$%&<>@^_~=+/\\", "punct": ".,;:?'\"()-", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": "0123456789", "space": " \t\n\v\f\r", "bars": "|", "bangs": "!"}.items()}
_ASCII = bytes(range(128))


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one text, in the order of STATS."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n, b = len(words), max(1, len(raw))
    of = {k: (len(raw) - len(raw.translate(None, v))) / b for k, v in _CLASSES.items()}
    ratio = lambda x: float(np.log1p(100 * x))
    triples = len(set(zip(words, words[1:], words[2:], strict=False)))
    return [
        float(np.log1p(len(raw))), float(np.log1p(n)), float(np.log1p((len(raw) - of["space"] * b) / max(1, n))), len(set(words)) / max(1, n), ratio(of["symbols"]), ratio(of["punct"]), ratio(of["upper"]), ratio(of["digits"]), ratio(of["space"]),
        float(np.log1p(len(lines))), ratio((len(lines) - len(set(lines))) / max(1, len(lines))), ratio(1 - triples / (n - 2) if n > 2 else 0.0), ratio(of["bars"]), ratio(of["bangs"]), ratio(len(raw.translate(None, _ASCII)) / b), float(np.log1p(max(map(len, words), default=0))),
    ]


def document_statistics(documents: DataFrame) -> DataFrame:
    """(doc_id, x array<double>) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([statistics(t) for t in batch.column("text").to_pylist()], pa.list_(pa.float64()))], ["doc_id", "x"])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Per class 0 and 1: mean, lower Cholesky factor of the covariance, its log determinant, log prior."""

    mean: tuple
    factor: tuple
    logdet: tuple
    prior: tuple

    def score(self, x: np.ndarray) -> np.ndarray:
        logs = []
        for mean, factor, logdet, prior in zip(self.mean, self.factor, self.logdet, self.prior, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            logs.append(prior - 0.5 * (logdet + (z * z).sum(0)))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -40, 40)))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    d = len(STATS)
    n, s, q = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for batch in batches:
        x = np.array(batch.column("x").to_pylist(), float).reshape(-1, d)
        y = batch.column("y").to_numpy(zero_copy_only=False)
        for k in (0, 1):
            n[k] += (y == k).sum()
            s[k] += x[y == k].sum(0)
            q[k] += x[y == k].T @ x[y == k]
    yield pa.RecordBatch.from_pydict({"y": pa.array([0, 1], pa.int32()), "v": pa.array([np.concatenate([[n[k]], s[k], q[k].ravel()]).tolist() for k in (0, 1)], pa.list_(pa.float64()))})


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", to_pooled: float = 0.2, to_diagonal: float = 0.1, floor: float = 1e-3) -> Discriminant | float:
    """Class Gaussians of the labelled rows of stats; a constant score when a class is missing."""
    rows = stats.join(one_label_per_doc(labels, label), "doc_id").select("x", "y")
    parts = rows.mapInArrow(_sums, "y int, v array<double>")
    summed = parts.select("y", F.posexplode("v").alias("i", "v")).groupBy("y", "i").agg(F.sum("v").alias("v")).collect()
    d = len(STATS)
    flat = np.zeros((2, 1 + d + d * d))
    for r in summed:
        flat[r["y"], r["i"]] = r["v"]
    n = flat[:, 0]
    if n.min() < 2:
        return 0.5 if n.sum() == 0 else float(n[1] > n[0])
    mean = flat[:, 1 : 1 + d] / n[:, None]
    cov = [flat[k, 1 + d :].reshape(d, d) / n[k] - np.outer(mean[k], mean[k]) for k in (0, 1)]
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / n.sum()
    shrunk = []
    for k in (0, 1):
        # Small classes lean more on the pooled covariance.
        a = min(1.0, to_pooled + d / n[k])
        c = (1 - a) * cov[k] + a * pooled
        shrunk.append((1 - to_diagonal) * c + to_diagonal * np.diag(np.diag(c)) + floor * np.eye(d))
    factor = tuple(np.linalg.cholesky(c) for c in shrunk)
    return Discriminant(tuple(mean), factor, tuple(2 * np.log(np.diag(f)).sum() for f in factor), tuple(np.log(n / n.sum())))


def score(stats: DataFrame, model: Discriminant | float) -> DataFrame:
    """(doc_id, score, predicted) of every row of stats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), float).reshape(-1, len(STATS))
            p = model.score(x) if isinstance(model, Discriminant) else np.full(len(x), float(model))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return stats.mapInArrow(run, "doc_id long, score double, predicted int")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 3) == 1
    stats = save(document_statistics(table(spark, sf_dir, "documents")), "quality-statistics")
    model = fit(stats, table(spark, sf_dir, "labels").where(~held_out))
    return score(stats, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
