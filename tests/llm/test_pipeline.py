"""The pipeline against a plain version of its exact stages, and the guard of the entry point."""

import duckdb
import public_tokenizers

import __spark_entry__
import corpus_pipeline
from sievecraft.llm import common, queries, separator_scan
from tests.llm.test_exact import SF, components, removed, shingles


def test_stages_equal_a_plain_version(spark):
    docs = common.table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES:
        given = docs
        docs = common.save(stage(spark, given, SF), f"test-{name}")
        before = {r.doc_id: r.text for r in given.collect()}
        after = {r.doc_id: r for r in docs.collect()}
        if name == "toxicity":
            labels = {r.doc_id: r.toxic for r in common.table(spark, SF, "labels").where("toxic is not null").collect()}
            gone, toxic = set(before) - set(after), {i for i, y in labels.items() if y == 1 and i in before}
            assert set(after) <= set(before) and not any(labels.get(i) == 0 for i in gone) and len(gone & toxic) > 0.5 * len(toxic) > 0
        elif name == "ngram_jaccard_join":
            assert set(after) == {i for i, (_, c) in components(before).items() if i == c}
        elif name == "suffix_array_dedup":
            ids = sorted(before)
            gone = dict(zip(ids, removed([before[i] for i in ids]), strict=True))
            assert set(after) == set(before) and all(after[i].text == before[i] for i in ids if gone[i][1] == 0)
            assert all(0 <= gone[i][0] - gone[i][1] - len(after[i].text.encode()) <= 6 * gone[i][2] for i in ids)
        elif name == "benchmark_decontamination":
            items = [shingles(r.text) for r in common.table(spark, SF, "benchmark").collect()]
            assert set(after) == {i for i, t in before.items() if not any(100 * len(s & shingles(t)) >= 80 * len(s) for s in items)}
        else:
            plain = separator_scan.encoding(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
            assert set(after) == set(before) and all(r.round_trip and r.n_tokens == len(plain.encode_ordinary(before[i] or "")) for i, r in after.items())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == given.columns


def test_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {f"op{n}_" for n in range(1, 14)} <= {f"{x.split('_')[0]}_" for x in names}


def test_leaks_equal_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    name = "op3_benchmark_decontamination"
    assert sorted(map(tuple, queries.QUERIES[name](spark, SF).collect())) == sorted(con.sql(queries.ORACLE_SQL[name]).fetchall())


def test_rows_of_repeated_and_null_ids(spark, tables):
    words = lambda k: " ".join(f"{k}{i}" for i in range(80))
    rows = [(1, words("a")), (1, words("a")), (2, words("a")), (None, words("b")), (None, words("b")), (None, words("b") + " end"), (4, words("c")), (5, words("d")), (5, words("c")), (None, words("e")), (6, words("e")), (7, None), (7, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.one_of_each_group(spark, docs, "")
    texts = [(r.doc_id, (r.text or "").removesuffix(" end")) for r in got.collect()]
    assert sorted(texts, key=repr) == sorted([(1, words("a")), (None, words("b")), (4, words("c")), (5, words("d")), (6, words("e")), (7, ""), (None, "")], key=repr)
    assert got.columns == docs.columns
    folder = tables(benchmark=spark.createDataFrame([(1, words("b")), (2, words("c"))], "item_id long, text string"))
    left = corpus_pipeline.drop_leaks(spark, docs, folder).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=repr) == sorted(((i, t) for i, t in rows if not (t or "").startswith(("b", "c"))), key=repr)


def test_every_query_on_awkward_tables(spark, docs, awkward, tables):
    """Null, repeated and missing ids, ties, a long text, columns with clashing names: each query gives its rows."""
    texts = list(awkward) + ["w1 w2 w3 w4 w5 w6 w7", "idiot scum w1", "w1 w2 w3 w4 w5 w6 w7", "w1 w2 w3 w4 w5 w6 w7"]
    ids = [*range(len(texts) - 4), 3, None, None, 3]
    labels = spark.createDataFrame([(k, k % 2, (k + 1) % 2, 1) for k in range(8)] + [(None, 1, 1, 2), (3, None, None, 3)], "doc_id long, quality int, toxic int, n int")
    items = spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6", 5), (None, None, 6), (2, "", 7)], "item_id long, text string, n_item int")
    vectors = spark.createDataFrame([(1, [0.5] * 8, 1, "x"), (1, [0.5] * 8, 1, "x"), (None, [0.1] * 8, None, "x"), (2, None, 1, "x")], "vec_id long, embedding array<float>, label int, code string")
    full = tables(documents=docs(texts, ids), labels=labels, benchmark=items, embeddings=vectors)
    empty = tables(documents=docs([]), labels=labels.limit(0), benchmark=items.limit(0), embeddings=vectors.limit(0))
    for name, query in queries.QUERIES.items():
        rows = query(spark, full).collect()
        assert query(spark, empty).collect() == []
        if name == "op3_benchmark_decontamination":
            assert sorted(((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in rows), key=repr) == [(3, 1, 2, 2), (None, 1, 2, 2)]
        elif name == "op11_lexical_search":
            # Both items' terms stand in few texts; the null item and the one without terms find nothing.
            assert {r.item_id for r in rows} == {1} and [r.rank for r in sorted(rows, key=lambda r: r.rank)] == list(range(1, len(rows) + 1)) and {r.doc_id for r in rows} <= set(ids)
        elif name == "op13_vector_codes":
            assert sorted(((r.vec_id, r.code, r.error) for r in rows), key=repr) == [(1, "00000000", 0), (1, "00000000", 0), (None, "01010101", 0)]
        else:
            assert sorted((r.doc_id for r in rows), key=repr) == sorted(ids, key=repr), name
    got = corpus_pipeline.run(spark, full).collect()
    assert corpus_pipeline.run(spark, empty).collect() == [] and {r.doc_id for r in got} <= set(ids) and all(r.round_trip for r in got)
