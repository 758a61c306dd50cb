"""Operators with one right answer, against brute force and the libraries."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sievecraft.llm import byte_bpe, common, decontamination, near_copies, quality_rules, repeats, separator_scan, token_codes

SF = "/root/testdata/sf0.001"
WORDS = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def real(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


def shingles(text, n=5):
    w = WORDS.findall((text or "").translate(LOWER))
    return set(zip(*(w[k:] for k in range(n)), strict=False)) if len(w) >= n else {tuple(w)} if w else set()


def components(texts):
    sets, parent = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_copies(spark, docs, awkward, real):
    base = " ".join(f"w{i}" for i in range(60))
    family = [base] + [base.replace(f"w{k} ", f"edit{k} ") for k in (5, 20, 40)] + [" ".join(f"w{i}" for i in range(k, 60)) for k in range(1, 12)]
    for texts in (dict(enumerate(awkward + family)), real):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_copies.near_copies(docs(list(texts.values()), list(texts))).collect()}
        assert got == components(texts)
    assert near_copies.near_copies(docs([])).collect() == []
    again = near_copies.near_copies(docs(["a b c d e f"] * 2 + [None], [3, 3, None])).collect()
    assert Counter((r.doc_id, r.component_id) for r in again) == Counter({(3, 3): 2, (None, None): 1})


@pytest.mark.parametrize("part", [4096, 4])
def test_groups_of_near_copies(docs, monkeypatch, part):
    """Families without an original, chains, template pages that nothing links, shared passages; also with bins in parts."""
    monkeypatch.setattr(near_copies, "PART_ROWS", part)
    rng = np.random.default_rng(part)
    texts = []
    for f in range(4):
        base = [f"f{f}w{i}" for i in range(90)]
        for _ in range(14):
            edited = list(base)
            for at in rng.choice(90, rng.integers(0, 6), replace=False):
                edited[at] = f"e{rng.integers(1 << 40)}"
            texts.append(" ".join(edited))
    page = [f"p{i}" for i in range(25)]
    texts += [" ".join(page + [f"own{k}x{i}" for i in range(4)]) for k in range(40)]
    texts += [" ".join([f"long{k}x{i}" for i in range(300)] + page) for k in range(6)]
    texts += [" ".join(f"c{i}" for i in range(k, k + 70)) for k in range(0, 60, 2)] + texts[:3]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_copies.near_copies(docs(texts)).collect()}
    assert got == components(dict(enumerate(texts)))


def test_template_pages_leave_their_lists(docs):
    """Pages that share all but four words link with nothing, and a list of their last key is empty; copies of them still link."""
    page = [f"p{i}" for i in range(21)]
    texts = [" ".join(page + [f"own{k}x{i}" for i in range(4)]) for k in range(200)]
    given = docs(texts + [" ".join([*page, "own3x0", "own3x1", "own3x2", "other"])]).select("doc_id", "text")
    lists = near_copies.list_keys(near_copies.stayed(common.save(near_copies.profiles(given), "test-profiles")))
    left = near_copies.possible(lists)
    assert left.select("cid").distinct().count() <= 3 < lists.select("cid").distinct().count()
    assert {r.component_id for r in near_copies.near_copies(given).where("doc_id in (3, 200)").collect()} == {3}


def test_tree_equals_all_pairs():
    rng = np.random.default_rng(5)
    sets = [rng.choice(2000, rng.integers(64, 120), replace=False).astype(np.uint64) for _ in range(40)]
    sets += [np.unique(np.concatenate([s[3:], rng.integers(5000, 9000, 3).astype(np.uint64)])) for s in sets]
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sets = [sets[i] for i in order]
    bits = near_copies.signatures(np.concatenate(sets), np.cumsum([0, *map(len, sets)]), 256)
    n, of = np.array([len(s) for s in sets]), np.arange(len(sets)) // 50
    found = {(min(a, b), max(a, b)) for i, j in near_copies.dual_traversal(of, n, bits, np.arange(len(sets)), 50) for a, b in zip(i.tolist(), j.tolist(), strict=True)}
    for a in range(len(sets)):
        for b in range(a):
            k = len(np.intersect1d(sets[a], sets[b]))
            if of[a] == of[b] and 100 * k >= 80 * (n[a] + n[b] - k):
                assert (b, a) in found


def removed(texts):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + 200] for b in raw for i in range(len(b) - 199))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [4000, 2])
def test_repeats(docs, awkward, real, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    passage = "".join(chr(97 + (i * i + i // 3) % 26) for i in range(260))
    texts = [t for t in awkward if len(t or "") < 10_000] + [f"pre{k}" + passage[k:] + f"post{k}" * k for k in range(8)] + ["ab" * 300, "x" * 199, "y" * 200, "z" * 201]
    for given in (texts, list(real.values())[:80]):
        got = repeats.digests(docs(given)).orderBy("doc_id").collect()
        assert [tuple(r)[1:] for r in got] == removed(given)
    assert repeats.digests(docs([])).collect() == []


def test_suffix_sort():
    rng = np.random.default_rng(0)
    for _ in range(20):
        blobs = [bytes(rng.integers(97, 99, rng.integers(1, 12)).astype(np.uint8)) for _ in range(rng.integers(1, 60))]
        raw, size = np.frombuffer(b"".join(blobs), np.uint8), np.array([len(b) for b in blobs])
        group = rng.integers(0, 4, len(blobs))
        order = repeats.suffix_sort(raw, repeats.prefix(raw), group, np.cumsum(size) - size, size)
        assert order.tolist() == sorted(range(len(blobs)), key=lambda i: (group[i], blobs[i], i))


def test_collision_is_noticed():
    raw = np.frombuffer(b"abcabd", np.uint8)
    repeats._verify(raw, np.array([0]), np.array([3]), np.array([2]))
    with pytest.raises(ArithmeticError):
        repeats._verify(raw, np.array([0]), np.array([3]), np.array([3]))


def test_leaks(spark, docs, awkward, real):
    items = [" ".join(f"q{i}x{k}" for i in range(n)) for k, n in enumerate((4, 5, 14, 40, 300))] + [None, ""]
    texts = awkward + ["start " + items[2] + " end", items[3].upper(), " ".join(items[4].split()[:250]), " ".join(items[4].split()[:230]), "q0x1 q1x1 q2x1 q3x1 q4x1"]
    bench = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)], "item_id long, text string, n_item int")
    got = {(r.doc_id, r.item_id): r.n_shared for r in decontamination.leaks(docs(texts), bench).collect()}
    want = {}
    for i, t in enumerate(texts):
        for k, x in enumerate(items):
            s = shingles(x) if len(WORDS.findall(x or "")) >= 5 else set()
            both = len(s & shingles(t))
            if s and 100 * both >= 80 * len(s):
                want[(i, k)] = both
    assert got == want and len(got) >= 4
    assert decontamination.leaks(docs([]), bench).count() == 0 and decontamination.leaks(docs(texts), bench.limit(0)).count() == 0


def test_segments():
    rng = np.random.default_rng(0)
    for top in (200, 60_000, 1 << 31):
        ids = rng.integers(0, top, 5000).astype(np.uint32)
        ids[rng.random(5000) < 0.5] %= 256
        s = token_codes.Segment(token_codes.pack(ids, np.array([5000]), np.array([1])))
        assert all((s.tokens(a, b) == ids[a:b]).all() for a, b in ((0, 5000), (513, 1777), (512, 4096), (7, 7), (4999, 5000)))
        assert all(s.token(i) == ids[i] for i in range(0, 5000, 41))
    with pytest.raises(ValueError):
        token_codes.Segment(b"nope")


def test_token_files(docs, awkward):
    from tokenizers import Tokenizer

    texts = [*awkward, "Ünïcode naïve ﬁ Σίσυφος", "it's <|endoftext|> x²", "á e b", "<|endoftext|> hi", "a<|startoftext|>b<|EndOfText|>c", "<|endoftext"]
    path = public_tokenizers.path("word_bpe_49k.json")
    got = token_codes.read_segments(token_codes.write_segments(docs(texts), path)).orderBy("doc_id").collect()
    whole, start = Tokenizer.from_file(path), 0
    for r, t in zip(got, texts, strict=True):
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_codes.read_segments(token_codes.write_segments(docs([]), path)).collect() == []


def test_separator_scan(spark, docs, awkward):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    blocks, order = separator_scan.write_flat(docs(awkward), path, block=7)
    enc = separator_scan.encoding(path)
    got = separator_scan.token_counts(blocks).join(order, ["file", "nth"]).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(enc.encode_ordinary(t or "")) + 1 for i, t in enumerate(awkward)}
    # A stream that is cut into blocks and files anywhere, with an open end.
    rng = np.random.default_rng(1)
    flat = np.where(rng.random(500) < 0.1, separator_scan.END, 5).astype("<u2")
    flat[-3:] = 5
    cuts = sorted({0, 500, *rng.integers(1, 500, 40).tolist()})
    rows = [(k // 6, k % 6, bytearray(flat[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    found = separator_scan.token_counts(spark.createDataFrame(rows, "file int, block long, payload binary")).orderBy("doc").collect()
    ends = np.flatnonzero(flat == separator_scan.END) + 1
    want = np.diff([0, *ends, 500]).tolist()
    assert [r.n_tokens for r in found] == want and [r.start for r in found] == [0, *ends] and [r.ended for r in found] == [True] * len(ends) + [False]


def test_byte_bpe(docs, awkward):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rng = np.random.default_rng(4)
    texts = [*awkward, "it's 12345 naïve  \n\n x y 日本語 🙂!!", "Æsop'll   go", "a" * 63, "é" * 40, "=" * 300 + " " * 90 + "x"]
    # One piece of 100,000 letters, and pieces around the size at which the fold changes.
    texts += ["".join(map(chr, rng.integers(97, 123, 100_000)))] + ["".join(map(chr, rng.integers(97, 110, n))) for n in range(58, 66)]
    texts += ["".join(rng.choice(["an", "in", "the", "q", "é", "ß", "ing", "1", "日"], 30)) for _ in range(200)]
    import tiktoken

    enc = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=separator_scan.rank_file(path), special_tokens={})
    # A small cache, so that most pieces are folded where they stand.
    coded = common.save(byte_bpe.encode(docs(texts), path, cache=20, keep=("text",)), "test-bpe")
    got = coded.collect()
    assert len(got) == len(texts)
    # Decoding knows nothing but the emitted ids.
    back = byte_bpe.decode_ids(coded.select("doc_id", "ids"), path).collect()
    assert {r.doc_id: bytes(r.decoded) for r in back} == {i: (t or "").encode() for i, t in enumerate(texts)}
    for r in got:
        t = r.text or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == enc.encode_ordinary(t) and bytes(r.decoded) == t.encode()
    assert byte_bpe.encode(docs([]), path).collect() == []


def test_byte_bpe_cache_holds_no_second_text(spark, docs):
    literals = common.save(byte_bpe.rank_literals(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), "test-ranks")
    known = byte_bpe.frequent(docs(["the house", "the naïve 日本語"]), literals, 100, 100).first()["known"]
    held = {piece: v for per in known for piece, v in per.items()}
    assert set(held) == {"the", " house", " naïve", " 日本語"}
    assert all(v.ids and v.back is None for v in held.values())


def test_byte_bpe_around_listed_sizes_and_shared_checksums(docs, monkeypatch):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(["an", "in", "the", "q", "é", "ß", "ing", "日本", "a" * 7], 40))[:n] for n in range(1, 90)] + ["aaaaa", "\x7f|\x00"]
    import tiktoken

    enc = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=separator_scan.rank_file(path), special_tokens={})
    # So few places that most are shared by many tokens.
    monkeypatch.setattr(byte_bpe, "PLACES", 1 << 12)
    got = byte_bpe.encode(docs(texts), path, cache=1).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in got} == {i: enc.encode_ordinary(t) for i, t in enumerate(texts)}
    assert {r.doc_id: bytes(r.decoded) for r in got} == {i: t.encode() for i, t in enumerate(texts)}


def test_byte_bpe_literals_are_small(spark):
    row = byte_bpe.rank_literals(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    # A small cache has few maps, and the strings of pieces that hardly occur are not listed.
    assert byte_bpe.slots(30_000) <= 1 << 13 and row.selectExpr("aggregate(spans, 0, (n, x) -> n + size(x))").first()[0] < 12_000


def test_byte_bpe_tells_ids_that_decode_to_another_text(docs, monkeypatch):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    monkeypatch.setattr(byte_bpe, "decode", lambda tokens, ids: F.when(F.size(ids) > 1, F.hex(F.lit("x|y"))).otherwise(F.array_join(F.transform(ids, lambda i: F.get(tokens, i)["bytes"]), "")))
    got = byte_bpe.encode(docs(["the the qzqzj the"]), path, cache=20).first()
    assert got.decoded == b"the thex|y the" and len(got.ids) > 16


def test_ranks_that_are_no_merge_list(spark, tmp_path):
    import base64

    ranks = [bytes([i]) for i in range(256)] + [b"abc", b"ab"]
    (tmp_path / "r").write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(ranks)))
    with pytest.raises(ValueError):
        byte_bpe.rank_literals(spark, str(tmp_path / "r"))


def test_rule_statistics(docs, awkward, real):
    texts = awkward + list(real.values())[:60] + ["a b c a b c a b", "x x x x x", "l1 a\nl2\nl1 a\n \n \nl1 a"]
    got = quality_rules.document_statistics(docs(texts)).orderBy("doc_id").collect()
    for r, t in zip(got, texts, strict=True):
        t = t or ""
        w = WORDS.findall(t)
        seen = Counter(zip(w, w[1:], w[2:], strict=False))
        cover = {k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if WORDS.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover))
    assert quality_rules.document_statistics(docs([])).collect() == []
    plan = quality_rules.document_statistics(docs(["x"])).withColumn("v", quality_rules.verdict([(quality_rules.Test("words", True, 3.0),)]))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow", plan.split("Physical Plan")[-1])


def test_components_by_stars(spark, monkeypatch):
    """Many small tasks, so that chains are joined by star contraction."""
    monkeypatch.setattr(near_copies, "LINKS", 15)
    rng = np.random.default_rng(2)
    links = [(i, i + 1) for i in range(40) if i % 13] + [tuple(map(int, sorted(rng.choice(np.arange(100, 160), 2, replace=False)))) for _ in range(25)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        p, q = sorted((root(a), root(b)))
        parent[q] = p
    got = {r.cid: r.comp for r in near_copies.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in list(parent)}


def test_counts_of_anchors_do_not_depend_on_how_many_are_held(spark, monkeypatch):
    rows = spark.createDataFrame([("abc " * 100,), ("x" + "abc " * 90,), ("".join(f"{k} " for k in range(200)),)] * 2, "text string").coalesce(1)
    count = lambda: {(r.g, r.n) for r in repeats.frequent_anchors(rows).collect()}
    want = count()
    assert repeats.ANCHORS <= 1 << 18
    monkeypatch.setattr(repeats, "ANCHORS", 1)
    assert want and count() == want
