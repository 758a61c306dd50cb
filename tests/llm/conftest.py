import pytest

#: Documents with every awkward case; the extra columns clash with names that operators use.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, spans string, word string"


@pytest.fixture(scope="session")
def docs(spark):
    def make(texts, ids=None, langs=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, (langs or {}).get(k, "en"), "s", len(t or ""), 7, "x", "y") for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def awkward():
    """Null, empty, blank, one word, a long text, ties and repeated rows."""
    long = " ".join(f"word{i % 997}x{i}" for i in range(30_000))
    same = "the quick brown fox jumps over the lazy dog and runs far away from here today"
    return [None, "", " \t\n", "one", long, same, same, same.upper(), "é" * 500, "# " * 300, "a b c d e", "\x00 nul"]


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    """Write named DataFrames as a data folder and give its path."""

    def write(**frames):
        folder = tmp_path_factory.mktemp("sf")
        for name, df in frames.items():
            df.write.parquet(f"{folder}/{name}.parquet")
        return str(folder)

    return write
