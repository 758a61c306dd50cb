"""Near copies: documents whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more.

Exact, in five steps:

1. Each text's shingle set gives a class (equal sets), a size and a *prefix*: its first
   ``n - ceil(0.8 n) + 1 + n // 10`` shingles in one global order. Two sets that link
   share ``1 + n // 10`` prefix shingles at least, n being the smaller size. Shingles
   known to be common come last in that order; which are, is found in a hashed share of
   the texts and changes the work only, never the links.
2. A class stays if enough of its prefix is shared with other classes; common shingles
   count as shared unseen. Few classes beside groups of copies stay.
3. The lists of the first ``n - ceil(0.8 n) + 1`` shingles, by size class, hold every
   link. A class leaves a list if too few of its shingles follow the list's for a link
   that shares none before it (such a link is in another list). Each list is filed in the *bin* of the member whose prefix is shared most (the
   likely original), so that the lists of one group of copies become one bin and a class
   is sent to few bins, not to each list.
4. A bin's classes become a signature tree: a leaf is a class, an inner node the OR of
   its children's bitmaps and the range of their sizes. The original is compared first.
   Then a dual traversal from (root, root) drops a pair of nodes when both are one
   component, when their sizes cannot link, or when the most tokens they can share are
   too few. Pairs that are left are checked on the sets at once, and links join their
   components, so that a task gives fewer links than it has classes and no pair is
   ever written that is not a link. First each class goes to its best bin only (a large
   bin in parts, each with the original); then all bins of lists that still hold two
   components are compared whole (a large bin in pairs of parts).
5. Components of the links: stars inside tasks of bounded size, then, if there is more
   than one such task, alternating star contraction.

Defined results: null and empty texts, and texts without words, have no shingle, link
with nothing, and their component is their own doc_id; a null doc_id counts only when
nothing else is in its component; repeated rows each get a row; very long texts are
used whole; a similarity of exactly 0.8 links. Extra columns go. Sets are known by
64-bit hashes of their shingles and a class by a 63-bit hash of those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, flat, save, share, steps, table
from .hashing import bitmap, marked, mix, prefix, span_hash

WORDS = 5
#: Texts hashed at once, in bytes.
STEP = 1 << 18
FAN = 8
#: Rows and bytes of sets in a part of a bin; a bin with more is dealt out in parts.
PART_ROWS, PART_BYTES = 4096, 16 << 20
#: Links that one task turns into stars.
LINKS = 250_000
#: At most so many shingles are ordered last.
COMMON = 200_000
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_BLANK = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])
_WEIGHT = np.random.default_rng(11).integers(1, 1 << 63, WORDS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts in ascending order per text, and the bounds of each text's."""
    raw, offsets = flat(texts)
    rows = len(texts)
    raw = _FOLD[raw]
    inside = ~_BLANK[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    first = np.flatnonzero(inside & (edge[:-1] | np.concatenate([[True], ~inside[:-1]])[: len(inside)]))
    last = np.flatnonzero(inside & (edge[1:] | np.concatenate([~inside[1:], [True]])[: len(inside)])) + 1
    word = span_hash(prefix(raw), first, last)
    doc = np.searchsorted(offsets, first, side="right") - 1
    count = np.bincount(doc, minlength=rows)
    start = np.cumsum(count) - count
    m = max(0, len(word) - WORDS + 1)
    h = np.zeros(m, np.uint64)
    for k in range(WORDS):
        h += word[k : k + m] * _WEIGHT[k]
    same = doc[:m] == doc[WORDS - 1 :][:m] if m else np.zeros(0, bool)
    h, of = mix(h[same]), doc[:m][same]
    few = np.flatnonzero((count > 0) & (count < WORDS))
    if len(few):
        short = np.zeros(len(few), np.uint64)
        for k in range(WORDS - 1):
            has = count[few] > k
            short[has] += word[start[few[has]] + k] * _WEIGHT[k]
        short += count[few].astype(np.uint64) * _WEIGHT[WORDS]
        h, of = np.concatenate([h, mix(short)]), np.concatenate([of, few])
    order = np.lexsort((h, of))
    h, of = h[order], of[order]
    if len(h):
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (of[1:] != of[:-1])])
        h, of = h[new], of[new]
    return h, np.concatenate([[0], np.cumsum(np.bincount(of, minlength=rows))])


def class_ids(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 64-bit id per set, whatever its order; -1 for the empty set."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(h * np.uint64(0x2545F4914F6CDD1D)), dtype=np.uint64)])
    n = np.diff(bounds)
    out = mix((total[bounds[1:]] - total[bounds[:-1]]) + n.astype(np.uint64) * _WEIGHT[0]) >> np.uint64(1)
    return np.where(n > 0, out.view(np.int64), -1)


def prefix_size(n: np.ndarray) -> np.ndarray:
    """Shingles of which two sets that link share one at least."""
    return n - (4 * n + 4) // 5 + 1


def size_class(n: np.ndarray) -> np.ndarray:
    """k with 2**k <= n < 2**(k+1), 6 at least."""
    return np.maximum(6, np.frexp(n.astype(float))[1] - 1)


def signatures(h: np.ndarray, bounds: np.ndarray, n_bits: int) -> np.ndarray:
    """A bitmap of n_bits for each set, as rows of 64-bit words."""
    rows = len(bounds) - 1
    out = np.zeros((rows, n_bits // 64), np.uint64)
    at_once = max(1, (16 << 20) // n_bits)
    for i in range(0, rows, at_once):
        j = min(rows, i + at_once)
        part = h[bounds[i] : bounds[j]]
        bits = np.zeros((j - i, n_bits), bool)
        bits[np.repeat(np.arange(j - i), np.diff(bounds[i : j + 1])), (part & np.uint64(n_bits - 1)).astype(np.int64)] = True
        out[i:j] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    return out


def common_shingles(documents: DataFrame) -> np.ndarray:
    """Shingles met three times or more in one batch of a hashed eighth of the texts: at most COMMON of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [shingle_sets(p.column("text"))[0] for p in steps(batch, "text", STEP)]
            h, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(h[n > 2].view(np.int64)), pa.array(n[n > 2])], ["h", "n"])

    sample = documents.where(share(F.col("doc_id"), 1 / 8)).select("text")
    found = sample.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(COMMON).toArrow()
    return np.sort(found["h"].to_numpy().view(np.uint64))


def profiles(documents: DataFrame) -> DataFrame:
    """(doc_id, cid, n, late, keys); keys, the prefix with its ``late`` common shingles last, only for the first row of a class in a batch."""
    common = documents.sparkSession.sparkContext.broadcast(common_shingles(documents))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = common.value
        for batch in batches:
            seen: set[int] = set()
            for part in steps(batch, "text", STEP):
                h, bounds = shingle_sets(part.column("text"))
                n = np.diff(bounds)
                cid = class_ids(h, bounds)
                known = np.zeros(len(h), bool)
                if len(last):
                    at = np.minimum(np.searchsorted(last, h), len(last) - 1)
                    known = last[at] == h
                new = np.array([c != -1 and c not in seen and not seen.add(c) for c in cid.tolist()], bool)
                # In each set the common shingles go to its end; both kinds stay in order of their hash.
                of = np.repeat(np.arange(len(n)), n)
                order = np.lexsort((known, of))
                h, known, of = h[order], known[order], of[order]
                take = np.where(new, np.minimum(n, prefix_size(n) + n // 10), 0)
                keep = np.arange(len(h)) - bounds[of] < take[of]
                late = np.bincount(of[keep & known], minlength=len(n))
                keys = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(take)]).astype(np.int32)), pa.array(h[keep].view(np.int64)), mask=pa.array(~new))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(cid), pa.array(n, pa.int64()), pa.array(late, pa.int64()), keys], ["doc_id", "cid", "n", "late", "keys"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, cid long, n long, late long, keys array<long>")


def shared_counts(keys: DataFrame) -> DataFrame:
    """(cid, k): of the rows (key, cid), how many keys of a class another class has too; classes without one are left out.

    The rows of a task come sorted, so a key is judged from its neighbours; nothing is held but a border row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counts(key: np.ndarray, cid: np.ndarray) -> pa.RecordBatch:
            begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            wide = np.repeat(cid[begin] != cid[np.append(begin[1:], len(key)) - 1], np.diff(np.append(begin, len(key))))
            once = np.concatenate([[True], (key[1:] != key[:-1]) | (cid[1:] != cid[:-1])])
            x, k = np.unique(cid[wide & once], return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(x), pa.array(k)], ["cid", "k"])

        key, cid = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            key, cid = np.concatenate([key, batch.column("key").to_numpy()]), np.concatenate([cid, batch.column("cid").to_numpy()])
            if not len(key):
                continue
            cut = np.searchsorted(key, key[-1])
            # Of a key that goes on, its first and last class decide; only its present rows are held.
            if cut:
                yield counts(key[:cut], cid[:cut])
                key, cid = key[cut:], cid[cut:]
        if len(key):
            yield counts(key, cid)

    return keys.repartition("key").sortWithinPartitions("key", "cid").mapInArrow(run, "cid long, k long").groupBy("cid").agg(F.sum("k").alias("k"))


def stayed(profile: DataFrame) -> DataFrame:
    """One row per class that may link: (cid, n, keys, rate), keys cut to what two sets that link share one of."""
    classes = profile.where("keys is not null")
    rare = classes.select("cid", F.explode(F.expr("slice(keys, 1, size(keys) - cast(late as int))")).alias("key"))
    counts = shared_counts(rare)
    enough = F.coalesce("k", F.lit(0)) + F.col("late") >= 1 + F.expr("n * 8 div 100")
    found = classes.join(counts, "cid", "left").where(enough)
    one = found.groupBy("cid").agg(F.first("n").alias("n"), F.first(F.expr("slice(keys, 1, cast(n - (4 * n + 4) div 5 + 1 as int))")).alias("keys"), F.first(((F.coalesce("k", F.lit(0)) + F.col("late")) / F.col("n"))).alias("rate"))
    return save(one, "copies-classes")


def list_keys(classes: DataFrame) -> DataFrame:
    """(cid, n, rate, list, size, rest): a class in the lists of its keys by size class, also the next if it can link with a member of that; rest, its shingles from the key on."""
    size = F.greatest(F.lit(6), F.floor(F.log2("n")).cast("int"))
    rows = classes.withColumn("size", size)
    sizes = F.when(F.expr("5 * n >= 4 * shiftleft(1L, size + 1)"), F.array("size", F.col("size") + 1)).otherwise(F.array("size"))
    rows = rows.select("cid", "n", "rate", F.explode(sizes).alias("size"), "keys").select("cid", "n", "rate", "size", F.posexplode("keys").alias("at", "key"))
    return rows.select("cid", "n", "rate", "size", F.xxhash64("key", "size").alias("list"), (F.col("n") - F.col("at")).alias("rest"))


def possible(lists: DataFrame) -> DataFrame:
    """The rows of lists that may hold the first key that two linked classes share.

    Such a pair shares no more than what is left in both from that key on, and it shares
    4/9 of the two sizes together; so a row goes if less is left than 4/9 of its size and
    the smallest one of its list. Pages of one template that share but their last key empty its list.
    """
    least = lists.groupBy("list").agg(F.min("n").alias("least"), F.min("cid").alias("low"), F.max("cid").alias("high")).where("low != high").select("list", "least")
    return save(lists.join(least, "list").where(9 * F.col("rest") >= 4 * (F.col("n") + F.col("least"))).drop("least", "rest"), "copies-possible")


def bins(lists: DataFrame, comp: DataFrame | None) -> DataFrame:
    """(cid, n, bin, original, size, lists): the bins of each class and how many of its lists are in them, for lists of two components or more."""
    own = lists if comp is None else lists.join(comp, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    c = "cid" if comp is None else "comp"
    kinds = own.groupBy("list").agg(F.min(c).alias("low"), F.max(c).alias("high"), F.max(F.struct("rate", "cid")).alias("top")).where("low != high")
    open_ = save(kinds.select("list", F.col("top.cid").alias("original")), "copies-lists")
    joined = lists.join(open_, "list").groupBy("cid", "original", "size").agg(F.first("n").alias("n"), F.count("*").alias("lists"))
    return joined.withColumn("bin", F.xxhash64("original", "size"))


def parts_of(rows: DataFrame) -> DataFrame:
    """rows with ``parts``: into how many parts its bin is cut."""
    parts = F.ceil(F.greatest(F.count("*") / PART_ROWS, F.sum("n") * 8 / PART_BYTES)).cast("int")
    large = save(rows.groupBy("bin").agg(parts.alias("parts")).where("parts > 1"), "copies-large")
    return rows.join(large, "bin", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))


class Level:
    """Nodes of one height over the lists of a batch."""

    def __init__(self, of, bits, low, high, spare, c_low, c_high, child):
        self.of, self.bits, self.low, self.high, self.spare, self.c_low, self.c_high, self.child = of, bits, low, high, spare, c_low, c_high, child

    def above(self) -> Level:
        new = np.concatenate([[True], self.of[1:] != self.of[:-1]])
        begin = np.flatnonzero(new)
        at = np.arange(len(self.of)) - np.repeat(begin, np.diff(np.append(begin, len(self.of))))
        first = np.flatnonzero(at % FAN == 0)
        return Level(self.of[first], np.bitwise_or.reduceat(self.bits, first), np.minimum.reduceat(self.low, first), np.maximum.reduceat(self.high, first), np.maximum.reduceat(self.spare, first), np.minimum.reduceat(self.c_low, first), np.maximum.reduceat(self.c_high, first), np.append(first, len(self.of)))

    def linkable(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Node pairs that may hold a link between two components."""
        mixed = ~((self.c_low[i] == self.c_high[i]) & (self.c_low[j] == self.c_high[j]) & (self.c_low[i] == self.c_low[j]))
        sizes = (5 * self.high[i] >= 4 * self.low[j]) & (5 * self.high[j] >= 4 * self.low[i])
        ok = np.flatnonzero(mixed & sizes)
        a, b = i[ok], j[ok]
        most = np.bitwise_count(self.bits[a] & self.bits[b]).sum(1, dtype=np.int64) + np.minimum(self.spare[a], self.spare[b])
        out = np.zeros(len(i), bool)
        out[ok] = (a == b) | (9 * most >= 4 * (self.low[a] + self.low[b]))
        return out


def dual_traversal(of: np.ndarray, n: np.ndarray, bits: np.ndarray, comp: np.ndarray, at_once: int = 100_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one list and two components that the bounds leave. Rows come sorted by list; bits have one width."""
    spare = n - np.bitwise_count(bits).sum(1, dtype=np.int64)
    levels = [Level(of, bits, n, n, spare, comp, comp, None)]
    while len(levels[-1].of) > len(np.unique(levels[-1].of)):
        levels.append(levels[-1].above())
    roots = np.arange(len(levels[-1].of))
    stack = [(len(levels) - 1, roots, roots)]
    while stack:
        h, i, j = stack.pop()
        if len(i) > at_once:
            half = len(i) // 2
            stack += [(h, i[:half], j[:half]), (h, i[half:], j[half:])]
            continue
        keep = levels[h].linkable(i, j)
        i, j = i[keep], j[keep]
        if h == 0:
            apart = i != j
            yield i[apart], j[apart]
            continue
        child = levels[h].child
        ci, cj = child[i + 1] - child[i], child[j + 1] - child[j]
        each = ci * cj
        pair = np.repeat(np.arange(len(i)), each)
        k = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        a, b = child[i][pair] + k // cj[pair], child[j][pair] + k % cj[pair]
        once = (i[pair] != j[pair]) | (a <= b)
        if once.any():
            stack.append((h - 1, a[once], b[once]))


class Group:
    """Classes of some bins, and the components that the bins' links make of them."""

    def __init__(self, of: np.ndarray, cid: np.ndarray, comp: np.ndarray, first: np.ndarray, size: int, h: np.ndarray, bounds: np.ndarray):
        self.of, self.cid, self.comp, self.first, self.h, self.bounds = of, cid, comp, first, h, bounds
        self.n = np.diff(bounds)
        self.bits = signatures(h, bounds, 16 << size)
        self.parent: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = self.parent.get(up, up)
            x = up
        return x

    def check(self, i: np.ndarray, j: np.ndarray) -> None:
        """Join the components of those pairs of rows whose sets link."""
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            p, q = self.root(int(self.comp[a])), self.root(int(self.comp[b]))
            if p == q:
                continue
            x, y = self.h[self.bounds[a] : self.bounds[a + 1]], self.h[self.bounds[b] : self.bounds[b + 1]]
            both = np.concatenate([x, y])
            both.sort()
            k = int(np.count_nonzero(both[1:] == both[:-1]))
            if 100 * k >= 80 * (len(x) + len(y) - k):
                self.parent[max(p, q)] = min(p, q)
                self.links.append((int(self.cid[a]), int(self.cid[b])))

    def run(self) -> list[tuple[int, int]]:
        rows = np.arange(len(self.of))
        leaf = Level(self.of, self.bits, self.n, self.n, self.n - np.bitwise_count(self.bits).sum(1, dtype=np.int64), self.comp, self.comp, None)
        i, j = self.first[rows != self.first], rows[rows != self.first]
        keep = leaf.linkable(i, j)
        self.check(i[keep], j[keep])
        comp = np.array([self.root(c) for c in self.comp.tolist()])
        low = np.full(self.of.max() + 1, np.iinfo(np.int64).max)
        high = np.full(self.of.max() + 1, np.iinfo(np.int64).min)
        np.minimum.at(low, self.of, comp)
        np.maximum.at(high, self.of, comp)
        order = np.lexsort((self.n, comp, self.of))
        order = order[(low != high)[self.of[order]]]
        if len(order):
            for i, j in dual_traversal(self.of[order], self.n[order], self.bits[order], comp[order]):
                self.check(order[i], order[j])
        return self.links


def links_of(rows: DataFrame) -> DataFrame:
    """(a, b): links that join the components of the rows' bins as all links would.

    rows (bin, size, head, cid, comp, s): complete bins; ``head``, the likely original of its bin.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(t: pa.Table) -> pa.RecordBatch:
            at, cid, comp, head, size = (t.column(c).to_numpy() for c in ("bin", "cid", "comp", "head", "size"))
            blobs = t.column("s")
            links: list[tuple[int, int]] = []
            for k in np.unique(size):
                mine = np.flatnonzero(size == k)
                of = np.unique(at[mine], return_inverse=True)[1]
                order = np.lexsort((~head[mine], of))
                mine, of = mine[order], of[order]
                sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in blobs.take(pa.array(mine))]
                bounds = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
                begin = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
                first = np.repeat(begin, np.diff(np.append(begin, len(of))))
                links += Group(of, cid[mine], comp[mine], first, int(k), np.concatenate(sets), bounds).run()
            a, b = zip(*links, strict=True) if links else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        held: list[pa.RecordBatch] = []
        rows = size = 0
        for batch in batches:
            for part in steps(batch, "s", 1 << 20):
                of = part.column("bin").to_numpy()
                cut = np.flatnonzero(of[1:] != of[:-1]) + 1
                begin = 0 if not held or held[-1].column("bin")[-1].as_py() != of[0] else int(cut[0]) if len(cut) else len(of)
                if held and begin < len(of) and (rows > PART_ROWS or size > PART_BYTES):
                    # Close at a border between bins.
                    yield found(pa.Table.from_batches([*held, part.slice(0, begin)]).combine_chunks())
                    held, rows, size, part = [], 0, 0, part.slice(begin)
                held.append(part)
                rows += part.num_rows
                size += part.column("s").nbytes
        if held:
            yield found(pa.Table.from_batches(held).combine_chunks())

    ordered = rows.select("bin", "size", "head", "cid", "comp", "s").repartition("bin").sortWithinPartitions("bin")
    return save(ordered.mapInArrow(run, "a long, b long"), "copies-links")


def class_sets(documents: DataFrame, classes: DataFrame) -> DataFrame:
    """(cid, s): the shingle sets of the classes, from the texts."""
    sent = documents.sparkSession.sparkContext.broadcast(bitmap(classes.select("cid"), "cid"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            for part in steps(batch, "text", STEP):
                h, bounds = shingle_sets(part.column("text"))
                cid = class_ids(h, bounds)
                keep = [i for i in np.flatnonzero(marked(sent.value, cid) & (cid >= 0)).tolist() if not (cid[i] in seen or seen.add(cid[i]))]
                yield pa.RecordBatch.from_arrays([pa.array(cid[keep]), pa.array([h[bounds[i] : bounds[i + 1]].tobytes() for i in keep], pa.binary())], ["cid", "s"])

    # A class comes from at most one row of each batch; of these, any will do.
    found = documents.select("text").mapInArrow(sets, "cid long, s binary").groupBy("cid").agg(F.first("s").alias("s"))
    return save(found.join(classes.select("cid"), "cid", "left_semi"), "copies-sets")


def components(links: DataFrame) -> DataFrame:
    """(cid, comp): the smallest id that each linked id reaches.

    As many tasks as there are LINKS links turn their links into stars. If that was one
    task, they are the components; else alternating large and small stars follow.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
        xs = list(parent)
        yield pa.RecordBatch.from_arrays([pa.array(xs, pa.int64()), pa.array([root(x) for x in xs], pa.int64())], ["u", "v"])

    links = links.select("a", "b")
    parts = -(-links.count() // LINKS)
    edges = save(links.repartition(max(1, parts)).mapInArrow(local, "u long, v long").where("u != v").distinct(), "copies-links")
    changed = parts > 1
    while changed:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # Every edge now points from the larger to the smaller id.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m")).where("u != v").distinct()
        after = save(small, "copies-stars")
        changed = after.exceptAll(edges).limit(1).count() or edges.exceptAll(after).limit(1).count()
        discard(edges)
        edges = after
    return edges.select(F.col("u").alias("cid"), F.col("v").alias("comp")).union(edges.select("v", "v").distinct())


def near_copies(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of documents (doc_id, text)."""
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    profile = save(profiles(documents), "copies-profiles")
    classes = stayed(profile)
    sets = class_sets(documents, classes)
    lists = possible(list_keys(classes))

    # Each class in its best bin; a large bin in parts, each with the original.
    every = save(bins(lists, None), "copies-bins")
    best = every.groupBy("cid").agg(F.max(F.struct("lists", "original", "size", "bin", "n")).alias("b")).select("cid", "b.*")
    best = save(parts_of(best), "copies-best")
    part = F.pmod(F.xxhash64("cid", F.lit("part")), F.col("parts"))
    heads = best.select("bin", "size", "parts", F.col("original").alias("cid")).distinct()
    heads = heads.select("size", "cid", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "bin").withColumn("head", F.lit(True))
    tails = best.where("cid != original").select("size", "cid", part.alias("part"), "bin", F.lit(False).alias("head"))
    rows = heads.unionByName(tails).withColumn("bin", F.xxhash64("bin", "part")).withColumn("comp", F.col("cid"))
    links = links_of(rows.join(sets, "cid"))
    comp = components(links)

    # All bins of lists that hold two components or more; a large bin in pairs of parts.
    open_ = save(parts_of(bins(lists, comp)), "copies-open")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    pairs = open_.withColumn("part", part).withColumn("other", other).withColumn("bin", F.xxhash64("bin", F.least("part", "other"), F.greatest("part", "other")))
    pairs = pairs.withColumn("head", F.col("cid") == F.col("original")).join(comp, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    more = links_of(pairs.join(sets, "cid"))
    comp = components(links.union(more)) if more.limit(1).count() else comp
    comp = save(comp, "copies-components")
    discard(classes, sets, lists, every, best, open_)

    # The smallest doc_id of each class, then of each component; only classes of several rows or links need a name.
    own = save(profile.where("n > 0").groupBy("cid").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")).join(comp, "cid", "left"), "copies-own")
    least = save(own.where("comp is not null").groupBy("comp").agg(F.min("least").alias("component_id")), "copies-least")
    linked = own.where("comp is not null").select("cid", "comp").join(least, "comp").select("cid", "component_id")
    named = save(linked.union(own.where("comp is null and rows > 1").select("cid", "least")).withColumn("named", F.lit(True)), "copies-named")
    discard(own, least)
    component = F.when(F.col("named"), F.col("component_id")).otherwise(F.col("doc_id"))
    return profile.select("doc_id", "cid", "n").join(named, "cid", "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s from w, unnest(range(1, greatest(cast(len(w) as bigint) - 4, 1) + 1)) as r(i) where len(w) > 0),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.s = b.s and a.doc_id < b.doc_id group by all),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)),
e as (select a, b from l union select b, a from l),
r(doc_id, c) as (select doc_id, doc_id from documents union select e.b, r.c from r join e on e.a = r.doc_id)
select d.doc_id, coalesce(n.n, 0) as n_shingles, d.c as component_id from (select doc_id, min(c) as c from r group by doc_id) d left join n using (doc_id)
"""
