"""Byte-level BPE with Spark's higher-order functions.

A text is cut by the tokenizer's pattern. The ranked merges of a piece are one fold over
its byte strings that are tokens, in order of rank: the state is a text of one character
per token, at first one per byte, and a step replaces the two characters whose merge
makes the token by the token's own. This gives what merging the lowest-ranked neighbours
again and again gives, as long as the ranks are those of a merge list: each token comes
out of its own bytes by merges of rising ranks, so that where a token's string begins and
ends at borders, its inside has come to the two tokens of its last merge. That is checked
when the rank file is read; other files are refused.

The ranks are a literal: a table by checksum names the token, or the few tokens, that a
string may be. A string that only shares a checksum costs a step that finds nothing.

Distinct pieces are encoded once where that pays: the most frequent ones of a hashed
sample of documents go into a map of at most ``cache`` pieces, which bounds what is sent
to executors. It saves time only: a piece that is not in it is folded where it stands,
with the same result, since joining rare pieces back would shuffle all texts.

Decoding looks each id's bytes up and concatenates them: piece by piece as the ids are
made, or from the emitted ids (``decode_ids``). The map of pieces takes only those whose
ids were decoded to the piece itself, so it need not hold the result. Ids travel as hex
text inside a row and decoded pieces as text, as arrays of text join in one pass.

Defined results: null and empty texts have no ids and decode to nothing; of equal
strings the leftmost is merged first; repeated rows each get a row; very long texts and
pieces are encoded whole (each step reads the piece once). Extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, save, share, table
from .separator_scan import rank_file

#: Pieces to a small map of the cache, about.
PIECES = 4
#: Places by checksum; most strings of a piece are no token, and an empty place tells.
PLACES = 1 << 20
#: Bytes of a piece whose strings are listed beforehand.
SHORT = 40
_ALTERNATIVES = public_tokenizers.PATTERN.split("|")
_WORDS = [x for x in _ALTERNATIVES if x in (r" ?\p{L}+", r" ?\p{N}+")]
#: The pattern in Java's syntax, where \s is ASCII by default. Words and numbers are tried first: no other alternative can begin where one of these matches, but for blanks, which come after them anyway.
PATTERN = "(?U)" + "|".join(_WORDS + [x for x in _ALTERNATIVES if x not in _WORDS])


def let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.transform(F.array(value), body)[0]


def slots(cache: int) -> int:
    """Small maps for so many pieces: a power of two, as a map's look-up reads all its keys."""
    return 1 << (cache // PIECES).bit_length()


def piece_slot(piece: Column, of: int) -> Column:
    return F.xxhash64(piece).bitwiseAND(F.lit(of - 1)).cast("int")


def rank_literals(spark: SparkSession, path: str) -> DataFrame:
    """A one-row table: ``ids``, by checksum the token of two bytes or more that has it, -1 for none, or ``n`` and more for
    a list of ``many``; ``old`` and ``new``, by id the characters that a merge takes and makes; ``id_of``, by character its
    id; ``tokens``, by id its little-endian and its bytes as hex; ``spans``, by a short piece's size the places and lengths
    of its strings.

    It goes to Spark as an Arrow table: written into the plan, its text would be kept with every query.
    """
    ranks = rank_file(path)
    by_id = sorted(ranks, key=ranks.get)
    merges = [last_merge(ranks, t) for t in by_id]
    if [ranks[t] for t in by_id] != list(range(len(by_id))) or merges.count(()) != 256 or None in merges:
        raise ValueError(f"the ranks of {path} are not those of a merge list")
    n, longest = len(by_id), max(map(len, by_id))
    # Bytes are the first 256 characters; surrogates are none.
    of_id = np.array([t[0] if len(t) == 1 else 256 + i + 2048 * (i >= 0xD700) for i, t in enumerate(by_id)])
    id_of = np.full(of_id.max() + 1, -1, np.int32)
    id_of[of_id] = np.arange(n)
    sign = list(map(chr, of_id.tolist()))
    longer = np.array([i for i, m in enumerate(merges) if m], np.int32)
    place = np.array([zlib.crc32(by_id[i]) for i in longer], np.int64) % PLACES
    longer = longer[np.argsort(place, kind="stable")]
    place, first, held = np.unique(np.sort(place), return_index=True, return_counts=True)
    shared = held > 1
    table = np.full(PLACES, -1, np.int32)
    table[place] = np.where(shared, n + np.cumsum(shared) - 1, longer[first] if len(longer) else 0)
    ends = np.concatenate([[0], np.cumsum(held[shared])]).astype(np.int32)
    many = pa.ListArray.from_arrays(pa.array(ends), pa.array(longer[np.repeat(shared, held)]))
    none = [""] * len(many)
    old, new = [sign[m[0]] + sign[m[1]] if m else "" for m in merges] + none, [s if m else "" for s, m in zip(sign, merges, strict=True)] + none
    tokens = pa.StructArray.from_arrays([pa.array([i.to_bytes(4, "little").hex() for i in range(n)]), pa.array([t.hex().upper() for t in by_id])], ["le", "bytes"])
    of = [(i, k) for size in range(SHORT + 1) for i in range(size) for k in range(2, min(longest, size - i) + 1)]
    start, size = np.array(of, np.int32).T
    of = [sum(min(longest, k - i) - 1 for i in range(k) if k - i > 1) for k in range(SHORT + 1)]
    spans = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(of)]).astype(np.int32)), pa.StructArray.from_arrays([pa.array(start + 1), pa.array(size)], ["at", "n"]))
    one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
    lists = {"ids": pa.array(table), "many": many, "old": pa.array(old), "new": pa.array(new), "id_of": pa.array(id_of), "tokens": tokens, "spans": spans}
    row = {k: one(x) for k, x in lists.items()} | {k: pa.array([x], pa.int32()) for k, x in (("n", n), ("longest", longest))}
    return spark.createDataFrame(pa.table(row))


def last_merge(ranks: dict[bytes, int], token: bytes) -> tuple[int, ...] | None:
    """The ids of the two tokens that make the token in the last of merges of rising ranks; () for a byte; None if no such merges do."""
    parts, last, made = [token[i : i + 1] for i in range(len(token))], -1, ()
    while len(parts) > 1:
        low, at = min((ranks.get(a + b, len(ranks)), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if low == len(ranks) or low < last:
            return None
        made = ranks.get(parts[at], -1), ranks.get(parts[at + 1], -1)
        parts[at : at + 2], last = [parts[at] + parts[at + 1]], low
    return None if -1 in made else made


def with_literals(df: DataFrame, literals: DataFrame) -> DataFrame:
    """df and the one-row table as column ``lit``.

    The column is a scalar subquery: Spark reads it once and sends it with the tasks.
    Use it once, as ``let(F.col("lit"), ..)``; the optimizer then puts the value in
    place of the column, so that no row carries it.
    """
    return df.withColumn("lit", literals.select(F.struct("*")).scalar())


def encode_piece(lit: Column, piece: Column) -> Column:
    """The ids of a piece of text: array<int>."""
    return let(piece.cast("binary"), lambda raw: _encode_bytes(lit, raw))


def _encode_bytes(lit: Column, raw: Column) -> Column:
    """The ids of a piece's bytes. Few nodes per string: the fold is interpreted, and its nodes are the work."""
    size = F.octet_length(raw)

    def strings(ids: Column) -> Column:
        """What the places of the piece's strings name."""
        named = lambda at, n: F.get(ids, F.crc32(F.substring(raw, at, n)).bitwiseAND(F.lit(PLACES - 1)).cast("int"))
        short = F.array_remove(F.transform(F.get(lit["spans"], size), lambda x: named(x["at"], x["n"])), -1)
        lengths = lambda i: F.sequence(F.lit(2), F.least(lit["longest"], size - i))
        # In a long piece a checksum without the bytes would come up too often.
        real = lambda v, at, n: (v < 0) | (v >= lit["n"]) | (F.get(lit["tokens"], v)["bytes"] == F.hex(F.substring(raw, at, n)))
        sure = lambda at, n: let(named(at, n), lambda v: F.when(real(v, at, n), v).otherwise(-1))
        at = lambda i: F.array_remove(F.transform(lengths(i), lambda n: sure(i + 1, n)), -1)
        return F.when(size <= SHORT, short).otherwise(F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), size - 2), at))))

    def all_tokens(found: Column) -> Column:
        return let(lit["n"], lambda n: F.concat(found, F.flatten(F.transform(F.filter(found, lambda v: v >= n), lambda v: F.get(lit["many"], v - n)))))

    def merged(found: Column) -> Column:
        step = lambda old, new: lambda m, v: F.replace(m, F.get(old, v), F.get(new, v))
        return let(lit["old"], lambda old: let(lit["new"], lambda new: F.aggregate(F.sort_array(found), F.decode(raw, "ISO-8859-1"), step(old, new))))

    found = let(let(lit["ids"], strings), all_tokens)
    return let(lit["id_of"], lambda id_of: F.transform(F.split(merged(found), ""), lambda c: F.get(id_of, F.ascii(c))))


def decode(tokens: Column, ids: Column) -> Column:
    """The concatenated bytes, as hex, of an array of ids."""
    return F.array_join(F.transform(ids, lambda i: F.get(tokens, i)["bytes"]), "")


def coded_piece(lit: Column, piece: Column) -> Column:
    """(ids, back): the piece's ids as little-endian hex, and the text that these ids decode to.

    Tokens may end within a character, but a piece is whole characters, and so is what its ids decode to.
    """
    le = lambda i: F.get(lit["tokens"], i)["le"]
    return let(encode_piece(lit, piece), lambda ids: F.struct(F.array_join(F.transform(ids, le), "").alias("ids"), F.unhex(decode(lit["tokens"], ids)).cast("string").alias("back")))


def decode_ids(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """rows with ``decoded``: the bytes of a binary column of little-endian 32-bit ids. Null ids decode to null; an unknown id makes the row's bytes null."""
    literals = save(rank_literals(rows.sparkSession, path), "bpe-ranks")
    size = (F.octet_length(F.col(ids)) / 4).cast("int")
    # Bytes of a binary are taken by place at once; places in a text would be counted from its start.
    at = lambda k: F.conv(F.concat(*[F.hex(F.substring(F.col(ids), k * 4 + i, F.lit(1))) for i in (4, 3, 2, 1)]), 16, 10).cast("int")
    places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).when(size == 0, F.array().cast("array<int>"))

    def told(x: Column) -> Column:
        found = F.transform(places, lambda k: F.get(x["tokens"], at(k))["bytes"])
        return let(found, lambda f: F.when(~F.exists(f, lambda t: t.isNull()), F.array_join(f, "")))

    return with_literals(rows, literals).withColumn("decoded", F.unhex(let(F.col("lit"), told))).drop("lit")


def pieces(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(PATTERN), F.lit(0))


def frequent(documents: DataFrame, literals: DataFrame, cache: int, sample: int) -> DataFrame:
    """A one-row table: encoded frequent pieces as an array of maps by slot. ``back`` is null: only pieces are kept whose ids were decoded to the piece."""
    total = max(1, documents.count())
    found = documents.where(share(F.col("doc_id"), min(1.0, sample / total))).select(F.explode(pieces(F.col("text"))).alias("piece"))
    top = save(found.groupBy("piece").count().orderBy(F.desc("count"), "piece").limit(cache).select("piece"), "bpe-frequent")
    # A few thousand pieces a task: the fold is the work, not the read.
    spread = with_literals(top.repartition(64, "piece"), literals)
    coded = spread.select("piece", let(F.col("lit"), lambda x: coded_piece(x, F.col("piece"))).alias("v"))
    exact = coded.where(F.col("v.back") == F.col("piece")).select("piece", F.struct(F.col("v.ids"), F.lit(None).cast("string").alias("back")).alias("v"))
    per = exact.groupBy(piece_slot(F.col("piece"), slots(cache)).alias("slot")).agg(F.collect_list(F.struct("piece", "v")).alias("e"))
    all_slots = documents.sparkSession.range(slots(cache)).select(F.col("id").cast("int").alias("slot"))
    none = F.array().cast("array<struct<piece:string,v:struct<ids:string,back:string>>>")
    filled = save(all_slots.join(per, "slot", "left").select("slot", F.coalesce("e", none).alias("e")), "bpe-slots")
    one = filled.agg(F.array_sort(F.collect_list(F.struct("slot", "e"))).alias("s")).select(F.transform("s", lambda x: F.map_from_entries(x["e"])).alias("known"))
    one = save(one, "bpe-known")
    discard(top, filled)
    return one


def encode(documents: DataFrame, path: str, cache: int = 300_000, sample: int = 40_000, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *keep, ids, decoded): binary columns of every row's little-endian ids and what they decode to."""
    literals = save(rank_literals(documents.sparkSession, path), "bpe-ranks")
    known = frequent(documents, literals, cache, sample)

    def coded(x: Column, known: Column) -> Column:
        def folded(p: Column) -> Column:  # what the ids decode to follows them only where it is not the piece
            return let(coded_piece(x, p), lambda v: F.when(v["back"] == p, v["ids"]).otherwise(F.concat(v["ids"], F.lit("|"), v["back"])))

        def decoded(c: Column, p: Column) -> Column:
            return F.when(F.contains(c, F.lit("|")), F.substring(c, F.instr(c, "|") + 1, F.length(c))).otherwise(p)

        def joined(ps: Column) -> Column:
            one = lambda p: F.coalesce(F.get(known, piece_slot(p, slots(cache)))[p]["ids"], folded(p))
            same = lambda c: F.struct(F.array_join(c, "").alias("ids"), F.array_join(ps, "").alias("back"))
            other = lambda c: F.struct(F.array_join(F.transform(c, lambda x: F.substring_index(x, "|", 1)), "").alias("ids"), F.array_join(F.zip_with(c, ps, decoded), "").alias("back"))
            return let(F.transform(ps, one), lambda c: let(same(c), lambda v: F.when(F.contains(v["ids"], F.lit("|")), other(c)).otherwise(v)))

        return let(pieces(F.col("text")), joined)

    rows = with_literals(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[c for c in keep if c not in ("doc_id", "text")]), literals)
    rows = rows.withColumn("known", known.select("known").scalar())
    found = let(F.col("known"), lambda k: let(F.col("lit"), lambda x: coded(x, k)))
    return rows.select("doc_id", *keep, found.alias("x")).select("doc_id", *keep, F.unhex("x.ids").alias("ids"), F.col("x.back").cast("binary").alias("decoded"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
