"""Ranked search, mixing and vector codes against plain versions, and on awkward input."""

import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sievecraft.llm import common, lexical_search, mixing, queries, vector_codes

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", ["op11_lexical_search", "op12_mixing", "op13_vector_codes"])
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.select(*columns).fetchall())


def ranked(texts, items, top=50):
    """texts: (doc_id, text). Every document scored for every item."""
    held = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in texts]
    held = [(i, c) for i, c in held if c]
    n, length, df = len(held), sum(sum(c.values()) for _, c in held), Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in held:
            m = 50 + 50 * sum(c.values()) * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(TERM.findall((text or "").translate(LOWER))) if c[t])
            found += [(-score, i is None, i)] if score > 0 else []
        out += [(item, k, i, -s) for k, (s, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("few", [False, True])
def test_search_equals_scoring_all(spark, docs, awkward, monkeypatch, few):
    """Ties, repeated rows and ids, null ids, counts beyond a byte, texts without a term; also with small sketches and steps, and one document in two leading."""
    if few:
        for name, value in (("SPREAD", 1), ("STEP_ROWS", 7), ("STEP", 50), ("LEAD", 2), ("BLOCK", 2)):
            monkeypatch.setattr(lexical_search, name, value)
    rng = np.random.default_rng(3)
    words = np.array([f"w{k}" for k in range(60)] + ["Ünï", "字", "A1"])
    texts = [" ".join(rng.choice(words, rng.integers(1, 40), p=np.arange(len(words), 0, -1) / sum(range(len(words) + 1)))) for _ in range(140)]
    texts += list(awkward) + ["w1 " * 300 + "w2", "w1 " * 254, "w3", "w3", "W3", "...", texts[0], texts[0]]
    ids = [*range(len(texts) - 3), None, None, 5]
    items = [(1, "w1 w2 w3 W3"), (2, "the quick fox"), (3, None), (4, "..."), (5, "nothing of it"), (6, "w3"), (7, "Ünï 字 a1 w59 w58"), (None, "w40 w41")]
    rows = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score int")
    got = lexical_search.search(lexical_search.build(docs(texts, ids).repartition(5)), rows)
    assert sorted(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect()), key=repr) == ranked(list(zip(ids, texts, strict=True)), items)


def test_items_of_one_id_are_one(spark, docs):
    index = lexical_search.build(docs(["a b", "b c", "c"]))
    rows = spark.createDataFrame([(1, "a"), (1, "b b"), (2, None)], "item_id long, text string")
    assert [(r.item_id, r.doc_id) for r in lexical_search.search(index, rows).orderBy("rank").collect()] == [(1, 0), (1, 1)]
    assert lexical_search.search(lexical_search.build(docs([])), rows).collect() == []
    assert lexical_search.search(lexical_search.build(docs([None, "", "!!"])), rows).collect() == []
    assert lexical_search.search(index, rows.limit(0)).collect() == []


def test_bounds_hold(docs):
    """No sketch's bound is below an exact score, and most documents are not scored."""
    texts = [" ".join(f"t{(k * 7 + i * i) % 400}" for i in range(30)) for k in range(400)]
    index = lexical_search.build(docs(texts))
    queries_ = lexical_search.weigh(index, [(1, sorted(f"t{k}".encode() for k in range(12)))])
    rows = index.rows().collect()
    for r in rows:
        sketch = np.frombuffer(r.sketch, np.uint8)
        tf = dict(zip(r.terms.split(b" "), np.frombuffer(r.counts, np.int32).tolist(), strict=True))
        assert all(sketch[h & (len(sketch) - 1)] >= min(255, tf[t]) for t, h in zip(tf, lexical_search.coordinates(list(tf)).tolist(), strict=True)) and sum(tf.values()) == r.n
    assert len(queries_.vocabulary) == 12 and len(rows) == 400


def targets(sizes):
    """By source its target, as shares that stop at three times its size."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight, limit, total = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, {s: 3 * sizes[s] for s in order}, sum(sizes.values())
    full = set()
    while True:
        free = [s for s in order if s not in full]
        share = Fraction(total - sum(limit[s] for s in full), sum(weight[s] for s in free)) if free else 0
        over = {s for s in free if weight[s] * share >= limit[s]}
        if not over:
            return {s: Fraction(limit[s]) if s in full else weight[s] * share for s in order}
        full |= over


def mixed(spark, rows):
    schema = "doc_id long, text string, source string, size int, copies string, idx int"
    return [r.asDict() for r in mixing.plan(spark.createDataFrame([(i, t, s, 1, "x", 2) for i, t, s in rows], schema), keep=("source",)).collect()]


@pytest.mark.parametrize("shape", ["many", "hot", "tiny"])
def test_mixing(spark, awkward, shape):
    rng = np.random.default_rng(len(shape))
    n = {"many": 12, "hot": 3, "tiny": 7}[shape]
    source = lambda k: None if k % n == 0 else f"s{k % n}" if shape != "hot" or k % 3 else "hot"
    size = lambda k: int(rng.integers(0, 3 if k % n == 1 and shape == "tiny" else 120))
    rows = [(k, " ".join(["w"] * size(k)), source(k)) for k in range(400)] + [(k, t, "odd") for k, t in enumerate(awkward)] + [(None, "a b", "odd")] * 3 + [(7, "a b", "odd")] * 3 + [(1, None, "empty"), (2, "", "empty"), (3, "Ä", "")]
    got = mixed(spark, rows)
    assert sorted((r["doc_id"], r["source"]) for r in got if r["doc_id"] is not None and r["source"]) == sorted((i, s) for i, _, s in rows if i is not None and s)
    sizes, longest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["size"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
        taken[r["source"]] += r["taken"]
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
    assert sum(sizes.values()) == sum(len(re.findall("[^\x20\x09-\x0d]+", t or "")) for _, t, _ in rows)
    want = targets(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == float(want[r["source"]])
        expected = want[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
        assert math.floor(expected) <= r["copies"] <= math.ceil(expected)
    assert all(abs(taken[s] - want[s]) <= 2 * longest[s] for s in sizes)
    key = lambda x: sorted(map(repr, x))
    assert key(mixed(spark, rows[::-1])) == key(got)


def test_mix_repeats_rows(spark, docs):
    rows = docs(["a b c", "d", None, "e f"]).withColumn("source", F.when(F.col("doc_id") < 2, "x").otherwise("y"))
    copies = {r.doc_id: r.copies for r in mixing.plan(rows).collect()}
    got = mixing.mix(rows)
    assert Counter(r.doc_id for r in got.collect()) == Counter({i: c for i, c in copies.items() if c}) and got.columns[:-1] == rows.columns
    assert mixing.plan(docs([])).collect() == [] and mixing.mix(docs([None])).collect() == []


def lloyd(rows, rounds=4, entries=256):
    """All distances in every round. rows: (vec_id, whole components)."""
    x = np.array([v for _, v in rows], np.int64).reshape(len(rows), 4, -1)
    first = {}
    for i, v in rows:
        first[i] = min(first.get(i, v), v)
    ids = sorted(first, key=lambda i: (i is None, i or 0))[:entries]
    books = np.array([first[i] for i in ids], np.int64).reshape(len(ids), 4, -1)
    for r in range(rounds + 1):
        d = ((x[:, None] - books[None]) ** 2).sum(3)
        code = d.argmin(1)
        if r < rounds:
            books = np.stack([np.stack([x[code[:, p] == e, p].sum(0) // max(1, (code[:, p] == e).sum()) if (code[:, p] == e).any() else books[e, p] for e in range(len(ids))]) for p in range(4)], 1)
    return code, d.min(1).sum(1), [books[:, p] for p in range(4)]


@pytest.mark.parametrize("kind", ["clusters", "ties", "few", "large"])
def test_codes_equal_all_distances(spark, kind):
    rng = np.random.default_rng(len(kind))
    n, dims = (40, 8) if kind == "few" else (900, 8)
    v = {"clusters": rng.normal(0, 0.05, (n, dims)) + rng.normal(0, 0.6, (30, dims))[rng.integers(0, 30, n)], "ties": rng.integers(-2, 3, (n, dims)) / 1024, "few": rng.normal(0, 1, (n, dims)), "large": rng.normal(0, 3e4, (n, dims))}[kind]
    ids = [int(i) for i in rng.permutation(n)]
    rows = [(i, [float(c) for c in x], i % 3 if i % 5 else None, 1) for i, x in zip(ids, v, strict=True)]
    rows += [rows[0], (ids[1], [0.5] * dims, 1, 1), (None, [0.25] * dims, 2, 1)]
    bad = [(-1, None, 1, 1), (-2, [1.0] * (dims - 1) + [None], 1, 1), (-3, [float("nan")] * dims, 1, 1), (-4, [float("inf")] * dims, 1, 1), (-5, [], 1, 1), (-6, [1.0] * 3, 1, 1), (-7, [1.0] * 2 * dims, 1, 1)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int, code int").repartition(3)
    limit = math.floor(vector_codes.LIMIT / math.sqrt(dims))
    whole = [(i, tuple(max(-limit, min(limit, math.floor(c * 1024))) for c in x)) for i, x, *_ in rows]
    code, error, books = lloyd(whole)
    got = vector_codes.compress(df)
    want = Counter((i, bytes(c.tolist()), int(e)) for (i, _), c, e in zip(whole, code, error, strict=True))
    assert Counter((r.vec_id, bytes(r.code), r.error) for r in got.rows.collect()) == want
    assert all(np.array_equal(a, b) for a, b in zip(got.codebooks, books, strict=True))
    everything = 4 * len(rows) * len(books[0])
    assert got.measured[0] <= everything + 4 * len(rows)
    if kind == "clusters":
        assert sum(got.measured[1:]) < 0.6 * 4 * everything


def test_bounds_are_tighter_than_added_moves():
    """An entry that goes and comes back is where it was."""
    rng = np.random.default_rng(1)
    steps = rng.integers(-9, 9, (3, 16, 4))
    history = np.stack([np.zeros((16, 4), np.int64), steps[0], steps[0] - steps[1], np.zeros((16, 4), np.int64)])
    book = vector_codes.Codebook(history, np.arange(16) % vector_codes.GROUPS)
    added = sum(np.sqrt(((history[k + 1] - history[k]) ** 2).sum(1)) for k in range(3))
    assert (book.displaced()[0] <= 1e-6).all() and (added > 1).all() and (book.displaced()[3] == 0).all()


def test_labels_and_empty_tables(spark, tables):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert queries.QUERIES["op13_vector_codes"](spark, tables(embeddings=none)).collect() == []
    rows = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 0.5], None), (2, [0.0] * 4, None), (3, [0.001] * 4, 1)], "vec_id long, embedding array<float>, label int")
    got = queries.QUERIES["op13_vector_codes"](spark, tables(embeddings=rows)).orderBy("vec_id").collect()
    assert [(r.vec_id, len(r.code), r.error, r.label_error) for r in got] == [(1, 8, 0, 0), (2, 8, 0, 0), (3, 8, 0, 0)]
    assert common.table(spark, SF, "embeddings").count() > 0
