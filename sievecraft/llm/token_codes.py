"""Token-id files of directly addressable codes.

A segment holds the ids of consecutive documents. Each id is cut into 8-bit chunks,
lowest first. Level k holds the k-th chunk of every id that reaches it, in order; a
bitmap tells which of a level's entries go on in the next one, and a rank directory
counts the set bits before each 512th, so the place of an id's next chunk is one
directory entry plus a few population counts. Any id is read without its neighbours.

Layout of a segment, little-endian::

    "DAC1", u8 levels, 3 zero bytes, u64 documents, u64 entries of each level
    i64 document id of each document (the smallest i64: null), u64 end of each document, in tokens
    per level: chunks; but for the last: bitmap (bit i of byte i/8), u32 rank before each 512 bits

Segments are the binary column of a Parquet table, so Spark's committer keeps one
copy of each whatever task attempts are lost. ``part`` orders the table: part p's
documents come before part p + 1's, and ``before`` counts the part's earlier ids.

Defined results: null and empty texts hold the end id only; null document ids sort
first; repeated rows each get their own ids; an empty table makes no segment.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import save, table

NULL_ID = -(1 << 63)
RANK_BITS = 512
#: Ids after which a segment ends, at a document's end.
SEGMENT = 1 << 20
END = 2


def pack(ids: np.ndarray, ends: np.ndarray, docs: np.ndarray) -> bytes:
    """One segment of the documents' ids."""
    levels, rest = [], ids.astype(np.uint64)
    while True:
        chunk, rest = (rest & np.uint64(255)).astype(np.uint8), rest >> np.uint64(8)
        more = rest > 0
        levels.append((chunk, more))
        if not more.any():
            break
        rest = rest[more]
    head = b"DAC1" + struct.pack("<B3xQ", len(levels), len(docs)) + struct.pack(f"<{len(levels)}Q", *(len(c) for c, _ in levels))
    body = [docs.astype("<i8").tobytes(), ends.astype("<u8").tobytes()]
    for chunk, more in levels:
        body.append(chunk.tobytes())
        if more is not levels[-1][1]:
            bits = np.packbits(more, bitorder="little")
            per = np.bitwise_count(np.pad(bits, (0, -len(bits) % (RANK_BITS // 8)))).reshape(-1, RANK_BITS // 8).sum(1, dtype=np.uint32)
            body += [bits.tobytes(), (np.cumsum(per, dtype=np.uint32) - per).astype("<u4").tobytes()]
    return head + b"".join(body)


class Segment:
    """Random access to a packed segment; nothing is decoded before it is asked for."""

    def __init__(self, payload: bytes):
        if payload[:4] != b"DAC1":
            raise ValueError("not a DAC1 segment")
        depth, n_docs = struct.unpack_from("<B3xQ", payload, 4)
        sizes = struct.unpack_from(f"<{depth}Q", payload, 16)
        at = 16 + 8 * depth

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        self.docs, self.ends = take("<i8", n_docs), take("<u8", n_docs)
        self.levels = []
        for k, n in enumerate(sizes):
            chunk = take("u1", n)
            last = k == depth - 1
            self.levels.append((chunk,) if last else (chunk, take("u1", -(-n // 8)), take("<u4", -(-n // RANK_BITS))))

    def _rank(self, level: int, i: int) -> int:
        """Entries before i that go on in the next level."""
        _, bits, ranks = self.levels[level]
        block = i // RANK_BITS
        if block == len(ranks):  # i is the level's length, at a directory border
            return len(self.levels[level + 1][0])
        first, whole = block * RANK_BITS // 8, i // 8
        tail = int(bits[whole]) & ((1 << i % 8) - 1) if i % 8 else 0
        return int(ranks[block]) + int(np.bitwise_count(bits[first:whole]).sum()) + tail.bit_count()

    def token(self, i: int) -> int:
        out, shift = 0, 0
        for level, parts in enumerate(self.levels):
            out |= int(parts[0][i]) << shift
            shift += 8
            if len(parts) == 1 or not parts[1][i // 8] >> (i % 8) & 1:
                return out
            i = self._rank(level, i)
        return out

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop, without decoding any other."""
        out, where = np.zeros(max(0, stop - start), np.uint32), None
        for level, parts in enumerate(self.levels):
            if stop <= start:
                break
            chunk = parts[0][start:stop].astype(np.uint32) << np.uint32(8 * level)
            if where is None:
                out, where = chunk, np.arange(stop - start)
            else:
                out[where] |= chunk
            if len(parts) == 1:
                break
            more = np.unpackbits(parts[1][start // 8 : -(-stop // 8)], bitorder="little")[start % 8 :][: stop - start].astype(bool)
            where = where[more]
            start, stop = self._rank(level, start), self._rank(level, stop)
        return out


#: Characters on which splitting at blanks, lower-casing and the pre-tokeniser agree with the
#: library word by word; a text with any other character, or with the string of an added
#: token, goes to the library whole.
PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-ɏ]*")
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Words and pieces whose ids a worker remembers before it starts over.
REMEMBER = 400_000
_loaded: dict[str, WordEncoder] = {}


class WordEncoder:
    """Ids of texts by a tokenizers file of word-piece merges; remembers frequent words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.added = regex.compile("|".join(regex.escape(t.content) for t in self.whole.get_added_tokens_decoder().values()) or r"(?!)", regex.IGNORECASE)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.as_bytes = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in shown)}
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        if (ids := self.pieces.get(piece)) is None:
            if len(self.pieces) >= REMEMBER:
                self.pieces.clear()
            shown = piece.encode().decode("latin-1").translate(self.as_bytes)
            ids = self.pieces[piece] = np.array([t.id for t in self.whole.model.tokenize(shown)], "<u4").tobytes()
        return ids

    def _word(self, word: str) -> bytes:
        if len(self.words) >= REMEMBER:
            self.words.clear()
        ids = self.words[word] = b"".join([self._piece(p) for p in PIECE.findall(word)])
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if not PLAIN.fullmatch(text) or self.added.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        known = self.words.get
        return np.frombuffer(b"".join([known(w) or self._word(w) for w in text.lower().split()]), "<u4")


def encoder(path: str) -> WordEncoder:
    """One per worker process, kept from task to task."""
    if path not in _loaded:
        _loaded[path] = WordEncoder(path)
    return _loaded[path]


def write_segments(documents: DataFrame, tokenizer: str, end_id: int = END, name: str = "token-codes") -> DataFrame:
    """Encode (doc_id, text) in ascending doc_id order into segments: (part, before, n_tokens, payload)."""
    spark = documents.sparkSession
    schema = "part int, before long, n_tokens long, payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encode, before = TaskContext.get().partitionId(), encoder(tokenizer).encode, 0
        ids, ends, docs, held = [], [], [], 0

        def segment() -> pa.RecordBatch:
            payload = pack(np.concatenate(ids), np.array(ends, np.uint64), np.array(docs, np.int64))
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "before": pa.array([before], pa.int64()), "n_tokens": pa.array([held], pa.int64()), "payload": pa.array([payload], pa.binary())})

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                got = np.append(encode(text.as_py()), np.uint32(end_id))
                ids.append(got)
                held += len(got)
                ends.append(held)
                docs.append(NULL_ID if doc is None else doc)
                if held >= SEGMENT:
                    yield segment()
                    before += held
                    ids, ends, docs, held = [], [], [], 0
        if docs:
            yield segment()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id").sortWithinPartitions("doc_id", "text")
    return save(ordered.mapInArrow(run, schema), name)


def read_segments(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the segments."""
    base, total = {}, 0
    for r in sorted(segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()):
        base[r["part"]] = total
        total += r["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before, payload in zip(*(batch.column(c) for c in ("part", "before", "payload")), strict=True):
                segment = Segment(payload.as_py())
                ends = segment.ends.astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                crc = [zlib.crc32(segment.tokens(a, b).astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                docs = pa.array(segment.docs, pa.int64(), mask=segment.docs == NULL_ID)
                yield pa.RecordBatch.from_arrays([docs, pa.array(starts + base[part.as_py()] + before.as_py()), pa.array(ends - starts), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return segments.select("part", "before", "payload").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_segments(write_segments(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))
