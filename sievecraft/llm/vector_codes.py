"""Vector code compression: four codebooks of 256 entries, learnt exactly with norm-of-sum bounds.

A vector is four parts, each coded by its nearest codebook entry. Every round assigns
all parts and moves the entries to their parts' floored means. The result is that of
looking at all entries in each round; most looks are spared:

The entries of a codebook are in groups of like ones. A part keeps for each group a
lower bound on its distance to the group's entries (its own entry aside) and the round
in which that was measured. All earlier codebooks are kept, so in a later round the
bound falls by how far an entry lies from where it was in that round, the norm of the
sum of its moves, and not by the sum of the norms of its moves: an entry that goes and
comes back costs nothing. A group whose bound is above the distance to the part's own
entry, which is measured anew, holds no nearer entry and no tie; the others are scanned
exactly. Bounds are rounded down and moves up, so rounding spares no look that matters.

Spark reads and writes the vectors with their bounds as a table a round; a task sums its
parts by entry, and only these sums (256 entries of a vector's length) reach the driver.
Distances are whole numbers: products of doubles while those are exact, else of longs.

Defined results: rows whose vector is null, empty, of a length not divisible by 4, of another
length than most have, or with a null or non-finite component are dropped; components
beyond +-LIMIT / sqrt(length) count as that limit, so that no sum overflows; a codebook has fewer
than 256 entries if fewer distinct vec_ids are kept; a repeated vec_id starts one entry, with its
smallest vector, a null one comes last; repeated rows are coded each; ties go to the lower index; an
empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, save, table
from .decontamination import bounded

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Groups of a codebook's entries that share a bound.
GROUPS = 16
#: A component is at most this over the square root of the length: squared distances of whole vectors stay below 2**61.
LIMIT = 2.0**29.5
#: A rounding error's share of a distance, at most.
SLACK = 1e-9
#: Distances that one step holds at once.
STEP = 1 << 20


@dataclass(frozen=True)
class Codebook:
    """One part's entries in all rounds so far (round, entry, position), and each entry's group."""

    history: np.ndarray
    group: np.ndarray

    def displaced(self) -> np.ndarray:
        """(round, group): how far the group's farthest entry is now from its place in that round."""
        moved = np.sqrt(((self.history - self.history[-1]).astype(float) ** 2).sum(2)) * (1 + SLACK)
        return np.stack([moved[:, self.group == g].max(1, initial=0) for g in range(GROUPS)], 1)


@dataclass
class Bounds:
    """Of some parts: nearest entry, its squared distance, and by group the lower bound and its round."""

    code: np.ndarray
    error: np.ndarray
    low: np.ndarray
    stamp: np.ndarray


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all entries, exact."""
    most = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    if 4.0 * most * most * max(1, x.shape[1]) < 2.0**52:
        a, b = x.astype(float), entries.astype(float)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in entries], 1)


def alike(entries: np.ndarray) -> np.ndarray:
    """A group for each entry: a few rounds of means over the (few) entries themselves."""
    centres = entries[np.linspace(0, len(entries) - 1, min(GROUPS, len(entries))).astype(int)].astype(float)
    for _ in range(6):
        of = ((entries[:, None, :] - centres[None]) ** 2).sum(2).argmin(1)
        centres = np.stack([entries[of == g].mean(0) if (of == g).any() else c for g, c in enumerate(centres)])
    return of


def assign(x: np.ndarray, book: Codebook, old: Bounds | None) -> tuple[Bounds, int]:
    """The nearest entries now, and how many distances were measured. old: of the round before, None in the first."""
    now, entries, n = len(book.history) - 1, book.history[-1], len(x)
    if old is None:
        old = Bounds(np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros((n, GROUPS), np.float32), np.zeros((n, GROUPS), np.uint8))
    own = ((x - entries[old.code]) ** 2).sum(1)
    low = old.low - book.displaced()[old.stamp, np.arange(GROUPS)]
    look = low <= np.sqrt(own.astype(float))[:, None] * (1 + SLACK)
    new = Bounds(old.code.copy(), own.copy(), old.low.copy(), old.stamp.copy())
    first = np.full((n, GROUPS), -1)
    nearest, second = np.zeros((n, GROUPS), np.int64), np.zeros((n, GROUPS), np.int64)
    measured = n
    far = np.iinfo(np.int64).max
    for g in range(GROUPS):
        members = np.flatnonzero(book.group == g)
        rows = np.flatnonzero(look[:, g]) if len(members) else members
        measured += len(rows) * len(members)
        for start in range(0, len(rows), max(1, STEP // max(1, len(members)))):
            r = rows[start : start + max(1, STEP // len(members))]
            d = squared(x[r], entries[members])
            at = d.argmin(1)
            k = np.arange(len(r))
            nearest[r, g], first[r, g] = d[k, at], members[at]
            d[k, at] = far
            second[r, g] = d.min(1)
        closer = (nearest[rows, g] < new.error[rows]) | ((nearest[rows, g] == new.error[rows]) & (first[rows, g] < new.code[rows]))
        r = rows[closer]
        new.code[r], new.error[r] = first[r, g], nearest[r, g]
    down = lambda d: np.nextafter((np.sqrt(d.astype(float)) * (1 - SLACK)).astype(np.float32), np.float32(-np.inf))
    for g in range(GROUPS):
        r = np.flatnonzero(first[:, g] >= 0)
        new.low[r, g] = down(np.where(first[r, g] == new.code[r], second[r, g], nearest[r, g]))
        new.stamp[r, g] = now
        # A part that left an entry of a group that was not scanned: that entry is one of the group's others now.
        r = np.flatnonzero((first[:, g] < 0) & (book.group[old.code] == g) & (new.code != old.code))
        new.low[r, g] = np.minimum(np.nextafter(low[r, g].astype(np.float32), np.float32(-np.inf)), down(own[r]))
        new.stamp[r, g] = now
    return new, measured


def _unpack(batch: pa.RecordBatch, name: str, kind, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(batch.num_rows, *shape)


def _pack(values: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(values)
    width = raw[:1].nbytes
    offsets = np.arange(len(raw) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(offsets), pa.py_buffer(raw.tobytes())])


_STATE = "vec_id long, label long, x binary, code binary, error long, low binary, stamp binary, measured long"


def _whole(length: int):
    """Vectors as whole numbers, in the shape of the rounds' tables."""
    limit = np.floor(LIMIT / np.sqrt(length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, length)
            with np.errstate(over="ignore"):
                x = np.clip(np.floor(x * SCALE), -limit, limit).astype(np.int32)
            none = pa.nulls(n, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), _pack(x), none, pa.nulls(n, pa.int64()), none, none, pa.nulls(n, pa.int64())], ["vec_id", "label", "x", "code", "error", "low", "stamp", "measured"])

    return run


def _round(books: list[Codebook], length: int, first: bool):
    width = length // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            x = _unpack(batch, "x", np.int32, PARTS, width).astype(np.int64)
            if not first:
                code, low, stamp = _unpack(batch, "code", np.uint8, PARTS).astype(np.int64), _unpack(batch, "low", np.float32, PARTS, GROUPS), _unpack(batch, "stamp", np.uint8, PARTS, GROUPS)
            got = [assign(x[:, p], books[p], None if first else Bounds(code[:, p], np.zeros(0), low[:, p], stamp[:, p])) for p in range(PARTS)]
            per = lambda name, kind: _pack(np.stack([getattr(b, name) for b, _ in got], 1).astype(kind))
            measured = pa.array([sum(m for _, m in got)] + [0] * (n - 1), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), batch.column("x"), per("code", np.uint8), pa.array(sum(b.error for b, _ in got)), per("low", np.float32), per("stamp", np.uint8), measured], ["vec_id", "label", "x", "code", "error", "low", "stamp", "measured"])

    return run


def _sums(length: int):
    """A task's sums: (part, entry, position, total), and at position -1 the number of parts."""
    width = length // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((PARTS, ENTRIES, width + 1), np.int64)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x, code = _unpack(batch, "x", np.int32, PARTS, width), _unpack(batch, "code", np.uint8, PARTS)
            for p in range(PARTS):
                order = np.argsort(code[:, p], kind="stable")
                used, start, n = np.unique(code[order, p], return_index=True, return_counts=True)
                total[p, used, 1:] += np.add.reduceat(x[order, p].astype(np.int64), start)
                total[p, used, 0] += n
        part, entry, at = np.nonzero(np.broadcast_to(total[:, :, :1] > 0, total.shape))
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(at.astype(np.int32) - 1), pa.array(total[part, entry, at])], ["part", "entry", "at", "total"])

    return run


def _moved(state: DataFrame, books: list[Codebook], length: int) -> list[Codebook]:
    """Codebooks with one more round: floored means, unused entries where they were."""
    got = state.select("x", "code").mapInArrow(_sums(length), "part int, entry int, at int, total long").groupBy("part", "entry", "at").agg(F.sum("total").alias("total")).toArrow()
    total = np.zeros((PARTS, ENTRIES, length // PARTS + 1), np.int64)
    total[tuple(got[c].to_numpy() + (c == "at") for c in ("part", "entry", "at"))] = got["total"].to_numpy()
    out = []
    for p, book in enumerate(books):
        last = book.history[-1]
        n = total[p, : len(last), 0]
        mean = np.where(n[:, None] > 0, total[p, : len(last), 1:] // np.maximum(n, 1)[:, None], last)
        out.append(Codebook(np.concatenate([book.history, mean[None]]), book.group))
    return out


@dataclass(frozen=True)
class Coded:
    """rows: (vec_id, label, code binary of PARTS bytes, error); measured: distances looked at in each assignment."""

    rows: DataFrame
    codebooks: list[np.ndarray]
    measured: list[int]


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> Coded | None:
    """Codes of vectors (vec_id, embedding, label); None if no vector is kept."""
    v = F.col("embedding").cast("array<double>")
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("embedding"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    kept = kept.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & (F.size("embedding") % PARTS == 0) & F.forall("embedding", finite))
    common = kept.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if common is None:
        return None
    length = common["n"]
    state = save(kept.where(F.size("embedding") == length).mapInArrow(_whole(length), _STATE), "codes-0")
    ids = state.select("vec_id").distinct().orderBy(F.col("vec_id").isNull(), "vec_id").limit(ENTRIES)
    signed = lambda raw: np.frombuffer(bytes(raw), np.int32).astype(np.int64)
    # The first vectors' rows; of a repeated id only distinct vectors, each at most once a task before they meet.
    start = state.select("vec_id", "x").join(F.broadcast(ids.withColumnRenamed("vec_id", "of")), F.col("vec_id").eqNullSafe(F.col("of"))).mapInArrow(_smallest, "vec_id long, x binary")
    best: dict[int | None, tuple] = {}
    for r in start.toLocalIterator():
        best[r["vec_id"]] = min(best.get(r["vec_id"], (np.inf,)), tuple(signed(r["x"]).tolist()))
    first = np.array([best[i] for i in sorted(best, key=lambda i: (i is None, i or 0))], np.int64).reshape(-1, PARTS, length // PARTS)
    books = [Codebook(first[None, :, p], alike(first[:, p])) for p in range(PARTS)]
    measured = []
    for r in range(rounds + 1):
        new = save(state.mapInArrow(_round(books, length, r == 0), _STATE), f"codes-{r + 1}")
        discard(state)
        state = new
        measured.append(int(state.agg(F.sum("measured")).first()[0]))
        if r < rounds:
            books = _moved(state, books, length)
    return Coded(state.select("vec_id", "label", "code", "error"), [b.history[-1] for b in books], measured)


def _smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By vec_id the smallest vector of a task: at most ENTRIES rows."""
    best: dict[int | None, tuple] = {}
    for batch in batches:
        for i, raw in zip(batch.column("vec_id").to_pylist(), batch.column("x").to_pylist(), strict=True):
            vector = tuple(np.frombuffer(raw, np.int32).tolist())
            if i not in best or vector < best[i][0]:
                best[i] = (vector, raw)
    yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.int64()), pa.array([raw for _, raw in best.values()], pa.binary())], ["vec_id", "x"])


def digest(codebooks: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for book in codebooks for v in book.ravel().tolist()).encode()).hexdigest()


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = compress(table(spark, sf_dir, "embeddings"))
    if coded is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    per = coded.rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    rows = coded.rows.join(bounded(save(per, "codes-labels")), F.col("label").eqNullSafe(F.col("of")))
    return rows.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(coded.codebooks)).alias("codebooks_sha256"))


def _sql() -> str:
    def nearest(r: int) -> str:
        return f"""a{r} as materialized (
  select v, p, x, arg_min(e, struct_pack(d := d, e := e)) as e, min(d) as d
  from (select k.v, k.p, k.x, b.e, list_sum(list_transform(list_zip(k.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as d from parts k join b{r} b using (p))
  group by v, p, x
)"""

    def moved(r: int) -> str:
        return f"""s{r} as (select p, e, i, cast(floor(sum(x[i]) / count(*)) as bigint) as x from a{r}, (select unnest(range(1, (select any_value(len(x)) + 1 from parts))) as i) group by p, e, i),
b{r + 1} as materialized (
  select b.p, b.e, coalesce(n.x, b.x) as x from b{r} b left join (select p, e, list(x order by i) as x from s{r} group by p, e) n using (p, e)
)"""

    steps = [x for r in range(ROUNDS) for x in (nearest(r), moved(r))] + [nearest(ROUNDS)]
    return f"""
with kept as materialized (
  select row_number() over () as v, vec_id, label, list_transform(embedding, lambda x: cast(floor(x * {SCALE}) as bigint)) as x
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as materialized (
  select v, p, x[p * len(x) // {PARTS} + 1 : (p + 1) * len(x) // {PARTS}] as x from kept, (select unnest(range({PARTS})) as p)
), b0 as materialized (
  select p, o - 1 as e, x from parts join (select v, row_number() over (order by vec_id) as o from kept) using (v) where o <= {ENTRIES}
), {", ".join(steps)}, c as (
  select v, string_agg(printf('%02x', e), '' order by p) as code, cast(sum(d) as bigint) as error from a{ROUNDS} group by v
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
  (select sha256(string_agg(array_to_string(x, ','), ',' order by p, e)) from b{ROUNDS}) as codebooks_sha256
from kept join c using (v)
"""


OP13_SQL = _sql()
