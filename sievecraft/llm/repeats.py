"""Removal of byte strings that repeat anywhere in the corpus.

Every byte inside a ``LENGTH``-byte string that also starts elsewhere is removed. A
window of that length is filed under its anchor: the lowest-hashed ``GRAM`` bytes in
it, so equal windows have the same anchor at the same distance. Consecutive windows
with one anchor are a *run*; only runs whose anchor's bytes occur twice in the
corpus can hold a repeated window.

Runs of one anchor meet in one task as short contexts. There the suffixes from the
anchor are sorted by a mergesort that compares by binary search on prefix polynomial
hashes, so a comparison takes logarithmically many look-ups; neighbours' common
extensions to the right, with the hash of the bytes to the left, tell which windows
are equal. Equal hashes are verified against the bytes.

Equal contexts are merged where they are made, so a passage in a third of all texts
sends one context per task, and an anchor that is very frequent is cut into blocks of
distances, filed by the bytes that all windows of the block share.

Defined results: null text counts as empty; texts shorter than LENGTH never lose a
byte; repeated rows are each other's copies, so they lose all, and each gets a row;
an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, flat, save, steps, table
from .hashing import bitmap, marked, mix, powers, prefix, sliding_min, span_hash

LENGTH, GRAM = 200, 64
#: Bytes hashed at once. A longer text is hashed in pieces that overlap by LENGTH - 1.
PIECE = 1 << 18
#: Hashes of anchors that a task holds and sends at once; their counts are added up again afterwards.
ANCHORS = 1 << 18
#: An anchor with more occurrences than this is cut into blocks of so many distances.
HOT, BLOCK = 4000, 16
#: Contexts that a task holds, to merge equal ones, before it sends them.
HELD = 20_000
#: Bytes of contexts sorted at once, but for a larger group.
GROUP_BYTES = 1 << 20
_LOW = np.uint64((1 << 21) - 1)


def runs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of all texts in the buffer: prefix hash, anchor's hash, anchor, first and last window start, and text of each run."""
    c = prefix(raw)
    span = LENGTH - GRAM + 1
    none = np.zeros(0, np.int64)
    if len(raw) < LENGTH:
        return c, none.view(np.uint64), none, none, none, none
    at = np.arange(len(raw) - GRAM + 1)
    gram = span_hash(c, at, at + GRAM)
    low = sliding_min((gram & ~_LOW) | at.astype(np.uint64), span)
    anchor = (low & _LOW).astype(np.int64)
    of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(anchor)]
    valid = np.flatnonzero(np.arange(len(anchor)) + LENGTH <= offsets[of + 1])
    if not len(valid):
        return c, none.view(np.uint64), none, none, none, none
    a, d = anchor[valid], of[valid]
    new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (d[1:] != d[:-1])]))
    first, last = valid[new], valid[np.concatenate([new[1:], [len(valid)]]) - 1]
    return c, gram[a[new]], a[new], first, last, d[new]


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, int]]:
    """Rows, their bytes, offsets, and how far into its text a lone piece of a long text starts."""
    for part in steps(batch, "text", PIECE):
        raw, offsets = flat(part.column("text"))
        if len(raw) <= 2 * PIECE:
            yield part, raw, offsets, 0
        else:
            for i in range(part.num_rows):
                text = raw[offsets[i] : offsets[i + 1]]
                for start in range(0, max(1, len(text) - LENGTH + 1), PIECE):
                    piece = text[start : start + PIECE + LENGTH - 1]
                    yield part.slice(i, 1), piece, np.array([0, len(piece)]), start


def frequent_anchors(rows: DataFrame) -> DataFrame:
    """(g, n): hashes of anchors that occur twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(held: list[np.ndarray]) -> pa.RecordBatch:
            g, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(n)], ["g", "n"])

        held, size = [], 0
        for batch in batches:
            for _, raw, offsets, _ in _pieces(batch):
                held.append(runs(raw, offsets)[1])
                size += len(held[-1])
                if size > ANCHORS:
                    yield counted(held)
                    held, size = [], 0
        if size:
            yield counted(held)

    return rows.select("text").mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).where("n > 1")


def contexts(rows: DataFrame, bits: np.ndarray, hot: np.ndarray) -> DataFrame:
    """Runs of marked anchors, as two kinds of rows.

    ``ref``: text (k1, k2) has context u with its first window at ``first``.
    ``ctx``: context u of group ``key``, whose windows lie ``low`` to ``high`` before
    the anchor, its bytes, and how often it was met here.
    """
    sent = rows.sparkSession.sparkContext.broadcast((bits, hot))
    names = ["kind", "key", "u", "k1", "k2", "first", "low", "high", "raw", "n"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, hot = sent.value

        def rows_of(kind: str, **columns) -> pa.RecordBatch:
            n = len(columns["u"])
            return pa.RecordBatch.from_arrays([pa.array([kind] * n) if c == "kind" else pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in zip(names, types, strict=True)], names)

        def contexts_of(met: dict[int, list]) -> pa.RecordBatch:
            key, low, high, blob, n = zip(*met.values(), strict=True)
            return rows_of("ctx", u=np.fromiter(met, np.uint64).view(np.int64), key=key, low=low, high=high, raw=blob, n=n)

        for batch in batches:
            met: dict[int, list] = {}
            for part, raw, offsets, skip in _pieces(batch):
                c, gram, anchor, first, last, text = runs(raw, offsets)
                keep = marked(bits, gram)
                gram, anchor, first, last, text = gram[keep], anchor[keep], first[keep], last[keep], text[keep]
                key = gram
                if len(hot) and len(gram):
                    at = np.minimum(np.searchsorted(hot, gram), len(hot) - 1)
                    key, anchor, first, last, text = _blocks(c, gram, anchor, first, last, text, hot[at] == gram)
                if not len(key):
                    continue
                low, high = anchor - last, anchor - first
                u = mix(span_hash(c, first, last + LENGTH) ^ mix(key + (low * 4096 + high).astype(np.uint64)))
                k1, k2 = (part.column(k).to_numpy(zero_copy_only=False) for k in ("k1", "k2"))
                yield rows_of("ref", u=u.view(np.int64), k1=k1[text], k2=k2[text], first=first - offsets[text] + skip)
                for x, k, lo, hi, s, e in zip(u.tolist(), key.view(np.int64).tolist(), low.tolist(), high.tolist(), first.tolist(), (last + LENGTH).tolist(), strict=True):
                    if x in met:
                        met[x][-1] += 1
                    else:
                        met[x] = [k, lo, hi, raw[s:e].tobytes(), 1]
                if len(met) > HELD:
                    yield contexts_of(met)
                    met.clear()
            if met:
                yield contexts_of(met)

    schema = "kind string, key long, u long, k1 long, k2 long, first long, low int, high int, raw binary, n long"
    return rows.mapInArrow(run, schema)


def _blocks(c, gram, anchor, first, last, text, hot):
    """Runs of hot anchors cut at fixed distances, each filed by the bytes that its possible windows share."""
    if not hot.any():
        return gram, anchor, first, last, text
    i = np.flatnonzero(hot)
    b0, b1 = (anchor[i] - last[i]) // BLOCK, (anchor[i] - first[i]) // BLOCK
    each = b1 - b0 + 1
    j = np.repeat(i, each)
    b = np.repeat(b0, each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    # What every window at these distances holds, whichever of them this run has.
    core = span_hash(c, np.maximum(anchor[j] - b * BLOCK, 0), np.minimum(anchor[j] + LENGTH - (b * BLOCK + BLOCK - 1), len(c) - 1))
    key = mix(gram[j] ^ mix(core + b.astype(np.uint64)))
    f, t = np.maximum(first[j], anchor[j] - b * BLOCK - BLOCK + 1), np.minimum(last[j], anchor[j] - b * BLOCK)
    cold = ~hot
    return tuple(np.concatenate([x[cold], y]) for x, y in ((gram, key), (anchor, anchor[j]), (first, f), (last, t), (text, text[j])))


def extension(c: np.ndarray, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Length of the common extension of suffixes i and j, up to limit: binary search on prefix hashes."""
    low, high = np.zeros(len(i), np.int64), limit.copy()
    inverse = powers(int(pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64)), len(c))
    ci, cj, pi, pj = c[i], c[j], inverse[i], inverse[j]
    while (low < high).any():
        mid = (low + high + 1) >> 1
        same = (c[i + mid] - ci) * pi == (c[j + mid] - cj) * pj
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def suffix_sort(raw: np.ndarray, c: np.ndarray, group: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Order of the suffixes by group, then bytes, then place: a bottom-up mergesort.

    All merges of a level run at once; a suffix's place in a merge is its own rank plus
    its rank in the other run, found by binary search.
    """
    n = len(start)
    order = np.lexsort((np.arange(n), group))
    padded = np.append(raw, 0)

    def before(x: np.ndarray, y: np.ndarray, tie: np.ndarray) -> np.ndarray:
        limit = np.where(group[x] == group[y], np.minimum(length[x], length[y]), 0)
        same = extension(c, start[x], start[y], limit)
        ended = same == np.minimum(length[x], length[y])
        byte = np.where(ended, length[x] < length[y], padded[start[x] + same] < padded[start[y] + same])
        equal = ended & (length[x] == length[y])
        return np.where(group[x] != group[y], group[x] < group[y], np.where(equal, tie, byte))

    width = 1
    while width < n:
        at = np.arange(n)
        run, rank = at // width, at % width
        other = (run ^ 1) * width
        size = np.clip(n - other, 0, width)
        # Runs whose border lies between two groups are in order as they stand.
        low, high = np.zeros(n, np.int64), size.copy()
        left = run % 2 == 0
        edge = np.minimum((run | 1) * width, n - 1)
        low[group[order[edge - 1]] != group[order[edge]]] = 0
        apart = (group[order[np.maximum(edge - 1, 0)]] != group[order[edge]]) & (size > 0)
        low = np.where(apart & ~left, size, low)
        high = np.where(apart & left, 0, high)
        while (open_ := np.flatnonzero(low < high)).size:
            mid = (low[open_] + high[open_]) >> 1
            theirs = order[other[open_] + mid]
            # In a tie the left run's suffix comes first.
            goes = before(theirs, order[open_], ~left[open_])
            low[open_] = np.where(goes, mid + 1, low[open_])
            high[open_] = np.where(goes, high[open_], mid)
        merged = np.empty(n, order.dtype)
        merged[(run // 2) * 2 * width + rank + low] = order
        order, width = merged, width * 2
    return order


def repeated_windows(key: np.ndarray, u: np.ndarray, low: np.ndarray, high: np.ndarray, blobs: list[bytes], n: np.ndarray) -> list[tuple[int, list[int]]]:
    """Per context with a repeated window: u and [first, last] window numbers of each stretch of them, flat.

    The contexts of a group must all be here; no two have the same u.
    """
    size = np.array([len(b) for b in blobs])
    raw = np.frombuffer(b"".join(blobs), np.uint8)
    c = prefix(raw)
    begin = np.cumsum(size) - size
    start = begin + high
    order = suffix_sort(raw, c, key, start, size - high)
    x, y = order[:-1], order[1:]
    common = np.where(key[x] == key[y], extension(c, start[x], start[y], np.where(key[x] == key[y], np.minimum(size[x] - high[x], size[y] - high[y]), 0)), -1)
    _verify(raw, start[x], start[y], common)
    ahead = np.concatenate([[-1], common])  # with the one before it in this order

    count = high - low + 1
    flags = np.repeat(n > 1, count)
    first = np.cumsum(count) - count  # the slot of window 0, the furthest before the anchor
    for o in range(int(low.min()), int(high.max()) + 1):
        has = (low <= o) & (o <= high)
        block = np.cumsum(ahead < LENGTH - o)  # neighbours that agree far enough to the right
        i = order[has[order]]
        if len(i) < 2:
            continue
        b = block[has[order]]
        left = span_hash(c, start[i] - o, start[i])
        by = np.lexsort((left, b))
        same = (b[by][1:] == b[by][:-1]) & (left[by][1:] == left[by][:-1])
        p, q = i[by][:-1][same], i[by][1:][same]
        _verify(raw, start[p] - o, start[q] - o, np.full(len(p), o))
        for z in (p, q):
            flags[first[z] + high[z] - o] = True
    out = []
    for j in np.flatnonzero(np.add.reduceat(flags, first)):
        f = np.diff(np.concatenate([[0], flags[first[j] : first[j] + count[j]].view(np.int8), [0]]))
        out.append((int(u[j]), np.stack([np.flatnonzero(f == 1), np.flatnonzero(f == -1) - 1], 1).ravel().tolist()))
    return out


def _verify(raw: np.ndarray, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> None:
    """Compare the bytes that hashes call equal; a collision stops the job rather than remove a wrong byte."""
    some = length > 0
    i, j, length = i[some], j[some], length[some]
    for at in range(0, len(i), 4096):
        a, b, m = i[at : at + 4096], j[at : at + 4096], length[at : at + 4096]
        k = np.arange(m.max())
        inside = k < m[:, None]
        last = len(raw) - 1
        if ((raw[np.minimum(a[:, None] + k, last)] != raw[np.minimum(b[:, None] + k, last)]) & inside).any():
            raise ArithmeticError("polynomial hash collision: change the table's seed")


def resolve(ctx: DataFrame) -> DataFrame:
    """(u, spans): the stretches of repeated windows of each context."""
    names = ["key", "u", "low", "high", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def solved() -> pa.RecordBatch:
            cols = [np.concatenate([h[i] for h in held]) for i in range(5)]
            blobs = [b for h in held for b in h[5]]
            key, u, low, high, n = cols
            _, at, same = np.unique(u, return_index=True, return_inverse=True)
            n = np.bincount(same, n).astype(np.int64)
            found = repeated_windows(key[at], u[at], low[at].astype(np.int64), high[at].astype(np.int64), [blobs[i] for i in at], n)
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([s for _, s in found], pa.list_(pa.int32()))], ["u", "spans"])

        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            blobs = batch.column("raw").to_pylist()
            start = 0
            # Rows come sorted by key: close what is held at a border between keys.
            for border in [*(np.flatnonzero(cols[0][1:] != cols[0][:-1]) + 1).tolist(), len(blobs)]:
                if held and size > GROUP_BYTES and cols[0][start] != held[-1][0][-1]:
                    yield solved()
                    held, size = [], 0
                if size + sum(map(len, blobs[start:border])) > GROUP_BYTES or border == len(blobs):
                    held.append((*(x[start:border] for x in cols), blobs[start:border]))
                    size += sum(map(len, blobs[start:border]))
                    start = border
        if held:
            yield solved()

    ordered = ctx.select(*names, "raw").repartition("key").sortWithinPartitions("key")
    return ordered.mapInArrow(run, "u long, spans array<int>")


#: Names of our own columns beside those of documents.
K1, K2, SPANS = "_repeats_k1", "_repeats_k2", "_repeats_spans"


def repeated_spans(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows, keyed, and (K1, K2, SPANS) of texts with repeats: byte ranges, flat, as start and end in turn."""
    rows = documents.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit(""))).withColumns({K1: F.xxhash64("doc_id"), K2: F.xxhash64("text")})
    long_enough = rows.where(F.octet_length("text") >= LENGTH).select(F.col(K1).alias("k1"), F.col(K2).alias("k2"), "text")
    twice = save(frequent_anchors(long_enough), "repeats-anchors")
    # At most all anchors / HOT of them.
    hot = np.sort(np.array([r["g"] for r in twice.where(F.col("n") > HOT).select("g").collect()], np.int64).view(np.uint64))
    both = save(contexts(long_enough, bitmap(twice, "g"), hot), "repeats-contexts")
    solved = save(resolve(both.where("kind = 'ctx'")), "repeats-spans")
    refs = both.where("kind = 'ref'").select("u", "k1", "k2", "first").distinct().join(solved, "u")
    to_bytes = F.transform("spans", lambda t, i: (F.col("first") + t + F.when(i % 2 == 1, LENGTH).otherwise(0)).cast("int"))
    per_text = refs.select(F.col("k1").alias(K1), F.col("k2").alias(K2), to_bytes.alias("s")).groupBy(K1, K2).agg(F.flatten(F.collect_list("s")).alias(SPANS))
    found = save(per_text, "repeats-texts")
    discard(twice, both, solved)
    return rows, found


def merged(spans: list[int]) -> list[tuple[int, int]]:
    """Maximal ranges of overlapping or touching ones."""
    out: list[list[int]] = []
    for start, end in sorted(zip(spans[::2], spans[1::2], strict=True)):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def apply_spans(documents: DataFrame, work, schema) -> DataFrame:
    """work(batch), with SPANS (null: no repeats) beside the columns of documents, over every row.

    Only texts that may have repeats are shuffled, to meet their spans; the others go
    through one Python step where they are read.
    """
    rows, found = repeated_spans(documents)
    bits = documents.sparkSession.sparkContext.broadcast(bitmap(found, K2))

    def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start in range(0, batch.num_rows, 512):
            yield work(batch.slice(start, 512))

    def of(batch: pa.RecordBatch, wanted: bool) -> pa.RecordBatch:
        return batch.filter(pa.array(marked(bits.value, batch.column(K2).to_numpy(zero_copy_only=False)) == wanted))

    def may_repeat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield of(batch, True)

    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = of(batch, False)
            yield from parts(rest.append_column(SPANS, pa.nulls(rest.num_rows, pa.list_(pa.int32()))))

    def with_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from parts(batch)

    joined = rows.mapInArrow(may_repeat, rows.schema).join(found, [K1, K2], "left")
    return joined.mapInArrow(with_, schema).unionByName(rows.mapInArrow(without, schema))


def kept_bytes(text: str, spans: list[int] | None) -> tuple[bytes, int, int, int]:
    """What is left, and bytes, removed bytes, removed ranges."""
    raw = (text or "").encode()
    out, last, gone = [], 0, merged(spans or [])
    for start, end in gone:
        out.append(raw[last:start])
        last = end
    out.append(raw[last:])
    left = b"".join(out)
    return left, len(raw), len(raw) - len(left), len(gone)


def remove_repeats(documents: DataFrame) -> DataFrame:
    """documents with repeats cut out of ``text``; a character that a cut leaves in part goes whole. Null texts become empty."""
    columns = documents.columns

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [kept_bytes(t, s)[0].decode("utf-8", "ignore") if s else t for t, s in zip(batch.column("text").to_pylist(), batch.column(SPANS).to_pylist(), strict=True)]
        return batch.select(columns).set_column(columns.index("text"), "text", pa.array(texts, pa.string()))

    return apply_spans(documents, work, documents.schema)


def digests(documents: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, digest = [], []
        for text, spans in zip(batch.column("text"), batch.column(SPANS), strict=True):
            left, *counts = kept_bytes(text.as_py(), spans.as_py())
            n.append(counts)
            digest.append(hashlib.sha256(left).hexdigest())
        n = np.array(n, np.int64).reshape(-1, 3)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(n[:, i]) for i in range(3)), pa.array(digest, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return apply_spans(documents, work, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
