"""Learned operators: held-out accuracy, and defined results for awkward input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievecraft.llm import language_id, quality_model, quality_rules, toxicity
from sievecraft.llm.common import fold

SF = "/root/testdata/sf0.01"


def accuracy(df, label, right):
    return df.where(f"held_out and {label} is not null").agg(F.avg(right.cast("double"))).first()[0]


def test_quality_held_out(spark):
    got = quality_model.op1_quality_classifier(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "left")
    assert got.count() == 1000 and accuracy(got, "quality", F.col("predicted") == F.col("quality")) > 0.97


def test_language_held_out(spark):
    got = language_id.op4_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert got.count() == 1000 and accuracy(got, "lang", F.col("lang") == F.col("lang_pred")) > 0.97


def test_toxicity_held_out(spark):
    got = toxicity.op7_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "left")
    assert got.count() == 1000 and accuracy(got, "toxic", F.col("predicted") == F.col("toxic")) > 0.95
    assert got.where("toxic = 0 and predicted = 1").count() <= 2


def test_interactions_are_learned(spark, docs):
    """Only the pair is toxic: neither word alone."""
    texts = [" ".join(w) for w in (("apple", "zorn"), ("apple", "calm"), ("stone", "zorn"), ("stone", "calm"))] * 60
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(240)], "doc_id long, toxic int")
    model = toxicity.fit(docs(texts), labels, epochs=60)
    got = {r.doc_id: r.predicted for r in toxicity.score(docs(texts), model).collect()}
    assert [got[i] for i in range(4)] == [1, 0, 0, 0]


def test_neutral_words_that_meet(spark, docs):
    """Toxic is both or none: each word alone says nothing."""
    texts = [" ".join(w) for w in (("apple", "zorn"), ("apple", "calm"), ("stone", "zorn"), ("stone", "calm"))] * 250
    labels = spark.createDataFrame([(i, int(i % 4 in (0, 3))) for i in range(1000)], "doc_id long, toxic int")
    model = toxicity.fit(docs(texts), labels, epochs=60)
    got = {r.doc_id: r.predicted for r in toxicity.score(docs(texts), model).collect()}
    assert [got[i] for i in range(4)] == [1, 0, 0, 1]


@pytest.mark.parametrize("share", [0.01, 0.08])
def test_rare_neutral_words_that_meet(spark, docs, share):
    """In a hundredth or a twelfth of 12,000 documents two of four words meet; only which two decides the label, elsewhere chance does."""
    rng = np.random.default_rng(int(share * 100))
    words = np.array([f"filler{k}" for k in range(300)])
    met = (("apple", "zorn"), ("apple", "calm"), ("stone", "zorn"), ("stone", "calm"))
    texts, labels = [], []
    for k in range(12_000):
        some, kind = " ".join(rng.choice(words, 12)), int(rng.integers(4))
        meets = k % 1000 < 1000 * share
        texts.append(f"{some} {' '.join(met[kind])}" if meets else some)
        labels.append((k, int(kind in (0, 3)) if meets else int(rng.random() < 0.3)))
    model = toxicity.fit(docs(texts), spark.createDataFrame(labels, "doc_id long, toxic int"), max_per_class=12_000)
    assert {toxicity.word_buckets(w)[0] for pair in met for w in pair} <= set(model.buckets.tolist())
    got = [r.score for r in toxicity.score(docs([" ".join(m) for m in met]), model).orderBy("doc_id").collect()]
    assert min(got[0], got[3]) > 0.5 > max(got[1], got[2])


def test_pairs_by_chance_are_not_kept(spark, docs):
    rng = np.random.default_rng(9)
    words = np.array([f"w{k}" for k in range(400)])
    texts = [" ".join(rng.choice(words, 20)) for _ in range(4000)]
    model = toxicity.fit(docs(texts), spark.createDataFrame([(k, int(rng.random() < 0.4)) for k in range(4000)], "doc_id long, toxic int"))
    assert len(model.buckets) <= 3


def test_rows_of_one_id_are_rows(spark, docs):
    """The words of two texts with the same id do not meet."""
    rows = docs(["apple", "zorn"] * 60 + ["apple zorn"] * 60, [0, 0] * 60 + list(range(1, 61)))
    model = toxicity.fit(rows, spark.createDataFrame([(0, 0)] + [(k, 1) for k in range(1, 61)], "doc_id long, toxic int"), epochs=60)
    got = [r.predicted for r in toxicity.score(docs(["apple", "zorn", "apple zorn"]), model).orderBy("doc_id").collect()]
    assert got == [0, 0, 1]


@pytest.mark.parametrize("values", [[], [(5, 1)], [(5, 0), (None, 1), (6, None)]])
def test_missing_classes(spark, docs, awkward, values):
    df = docs(awkward)
    quality, toxic = (spark.createDataFrame(values, f"doc_id long, {c} int") for c in ("quality", "toxic"))
    stats = quality_model.document_statistics(df)
    for scored in (quality_model.score(stats, quality_model.fit(stats, quality)), toxicity.score(df, toxicity.fit(df, toxic))):
        rows = scored.collect()
        assert len(rows) == len(awkward) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert quality_rules.fit(quality_rules.document_statistics(df), quality) == []


def test_language_of_awkward_texts(docs, awkward):
    df = docs(awkward)
    for model in (language_id.fit(df), language_id.fit(docs([]))):
        got = {r.doc_id: r for r in language_id.predict(df, model, reject=False).collect()}
        assert len(got) == len(awkward)
        for i, t in enumerate(awkward):
            letters = t is not None and any(c.isalpha() for c in t)  # isalpha is category L
            assert got[i].lang_pred == ("en" if letters and model.langs else "und") and 0 <= got[i].score <= 1


def test_marks_that_are_no_letters(docs):
    import unicodedata

    texts = ["²", "½ ⅓", "①②", "Ⅷ", "12 _ %", "ª", "٣", "字", "ǅ", "\u0301", "x²"]
    df = docs(texts)
    got = {r.doc_id: r for r in language_id.predict(df, language_id.fit(docs(["some words here", "more words there"])), reject=False).collect()}
    assert [got[i].lang_pred for i in range(len(texts))] == ["en" if any(unicodedata.category(c)[0] == "L" for c in t) else "und" for t in texts]


def test_far_texts_are_rejected(spark, docs):
    model = language_id.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    got = language_id.predict(docs(["qqqq zzzz xxxx kkkk wwww " * 20, "the and of ing er on with the that"]), model).orderBy("doc_id").collect()
    assert got[0].lang_pred == "und" and got[0].rejected


def test_rules_keep_clean_documents(spark):
    got = quality_rules.op10_quality_rules(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    clean = got.where("quality = 1 and not base_failed")
    assert clean.where("not kept").count() == 0 and got.where("base_failed and kept").count() == 0


def test_folds(spark):
    got = spark.createDataFrame([(0,), (12,), (None,)], "doc_id long").select(fold(F.col("doc_id"), 5).alias("f")).collect()
    import zlib

    assert [r.f for r in got] == [zlib.crc32(b"0") % 5, zlib.crc32(b"12") % 5, 0]
