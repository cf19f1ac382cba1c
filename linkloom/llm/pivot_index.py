"""Near duplicates of embeddings by a pivot-permutation index.

A bounded sample of the vectors are pivots. Each vector is described by its nearest pivots in
order of nearness: near vectors have most of them in common, at nearly the same places.
Inverted lists by pivots retrieve pairs with the number of pivots they share and how far these
are displaced; pairs with enough shared pivots and little displacement are verified by exact
cosine.

A list holds the vectors that have two pivots in common. A pair meets in the list of the first
two pivots, by number, that it shares, and is left out of all its other lists; so a vector is
only in lists of two of its pivots that can be the first two of ``min_shared``. With a fixed
number of pivots, recall doesn't depend on the number of vectors.

Equal vectors are one entry with their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import cut, drop_cut, release
from linkloom.llm.links import classes, in_blocks, linked, pairs_of_lists

_ROWS_AT_ONCE = 2048
_PAIRS_AT_ONCE = 200_000


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float32).reshape(len(column), -1)


def _rows(column: pa.Array, kind: type, width: int) -> np.ndarray:
    """A binary column, all of whose values have ``width`` numbers, as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, k: int) -> np.ndarray:
    """For each unit vector the numbers of its k nearest pivots, nearest first; ties go to the lower number."""
    s = np.round(x @ pivots.T, 6)
    k = min(k, s.shape[1])
    return np.argsort(-s, axis=1, kind="stable")[:, :k] if s.shape[1] <= 4 * k else _top(s, k)


def _top(s: np.ndarray, k: int) -> np.ndarray:
    at = np.argpartition(-s, k - 1, axis=1)[:, :k]
    edge = np.take_along_axis(s, at, 1).min(1)
    tied = (s >= edge[:, None]).sum(1) > k
    order = np.lexsort((at, -np.take_along_axis(s, at, 1)), axis=1)
    out = np.take_along_axis(at, order, 1)
    if tied.any():
        out[tied] = np.argsort(-s[tied], axis=1, kind="stable")[:, :k]
    return out


def spread_out(x: np.ndarray, m: int) -> np.ndarray:
    """Up to m of the unit vectors, each the farthest from those before it: a dense group, be it a third of all vectors, doesn't get a third of the pivots."""
    chosen = []
    nearness = np.full(len(x), -np.inf, x.dtype)
    at = 0
    for _ in range(min(m, len(x))):
        chosen.append(at)
        np.maximum(nearness, x @ x[at], out=nearness)
        nearness[at] = np.inf
        at = int(nearness.argmin())
    return x[chosen]


def retrieved(near: np.ndarray, i: np.ndarray, j: np.ndarray, first: np.ndarray, second: np.ndarray, min_shared: int, most_displaced: int) -> np.ndarray:
    """Which of the pairs (i, j) have enough shared pivots, the first two of them by number being these, and displacement that is small enough.

    ``near``: a row of pivots for each vector, nearest first. A shared pivot is displaced by the
    difference of its places; a pivot that only one vector has, by the places from its own to the end.
    """
    k = near.shape[1]
    a, b = near[i], near[j]
    shared = np.zeros(len(i), np.int64)
    displaced = np.zeros(len(i), np.int64)
    before = np.zeros(len(i), np.int64)
    places = np.arange(k)
    missing = np.full(len(i), k * (k + 1) // 2)
    for q in range(k):
        same = b == a[:, q : q + 1]
        hit = same.any(1)
        at = (same * places).sum(1)
        shared += hit
        displaced += np.where(hit, np.abs(at - q), k - q)
        missing -= np.where(hit, k - at, 0)
        before += hit & (a[:, q] <= second)
    # the pair is in the list of first and second, so both are shared; no other shared pivot may come before the second
    return (shared >= min_shared) & (before == 2) & (displaced + missing <= most_displaced)


def _retrieve(k: int, min_shared: int, most_displaced: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("entries")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            offsets -= offsets[0]
            entries = lists.flatten()
            ids, block = np.asarray(entries.field(0)), np.asarray(entries.field(2))
            near = _rows(entries.field(1), np.int16, k)
            apart, pivots = np.asarray(batch.column("apart").cast(pa.int8())).astype(bool), np.asarray(batch.column("pivots"))
            for of, i, j in pairs_of_lists(offsets, _PAIRS_AT_ONCE):
                keep = ~apart[of] | (block[i] != block[j])
                of, i, j = of[keep], i[keep], j[keep]
                hit = retrieved(near, i, j, pivots[of] >> 16, pivots[of] & 0xFFFF, min_shared, most_displaced)
                i, j = ids[i[hit]], ids[j[hit]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(i, j)), pa.array(np.maximum(i, j))], ["a", "b"])
            release()

    return run


def _similar(threshold: float, dimension: int):
    def judge(payload: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = np.frombuffer(b"".join(payload), np.float32).reshape(-1, dimension)
        norm = np.sqrt(np.einsum("ij,ij->i", x, x, dtype=np.float64))
        cosine = np.empty(len(a))
        for at in range(0, len(a), 1 << 14):
            p, q = a[at : at + (1 << 14)], b[at : at + (1 << 14)]
            cosine[at : at + (1 << 14)] = np.einsum("ij,ij->i", x[p], x[q], dtype=np.float64) / (norm[p] * norm[q])
        return cosine >= threshold - 1e-9

    return judge


def embedding_classes(vectors: DataFrame, *, threshold: float = 0.95, pivots: int = 1024, sample: int = 8192, nearest: int = 10, min_shared: int = 4, most_displaced: int = 76, list_at_once: int = 256, pairs_at_once: int = 100_000) -> DataFrame:
    """(vec_id, class_id, n_links): a row for each vector that is linked to another one.

    Two vectors are linked if their cosine is ``threshold`` at least and the index retrieves the
    pair. ``n_links`` counts a vector's links, equal vectors included, all of which are found.
    Vectors that links lead to, over others too, are a class; ``class_id`` is its smallest
    vec_id. A vector without a link has no row. Every vector is a query and every vector is indexed.

    Search is approximate: a pair is found if it shares ``min_shared`` of the ``nearest`` pivots
    of both, which are displaced by ``most_displaced`` places in all (0 for the same order,
    nearest * (nearest + 1) if nothing is shared). The pivots are at most ``pivots`` vectors, and
    at most a quarter of a sample (but 32), chosen to lie far apart; the sample is that of the
    ``sample`` different vectors with the smallest hash. Of pairs at a cosine of 0.95, 0.98
    are found, on isotropic and on clustered vectors; of closer ones nearly all. ``list_at_once``
    and ``pairs_at_once`` bound the memory of a task, and don't change the result.

    Null identifiers, and vectors that are null, empty, zero or hold nulls, NaN or infinity,
    match nothing, nor do vectors whose dimension isn't the most frequent one (of ties, the
    smallest). Repeated rows count once; of an identifier with several vectors that with the
    smallest hash is used. An empty table gives an empty result; other columns are ignored.
    """
    if not 1 <= min_shared <= nearest or not -1 <= threshold <= 1 or not 2 <= pivots < 1 << 15:
        raise ValueError("min_shared must be from 1 to nearest, threshold a cosine, pivots from 2 to 32,767")
    v = vectors.select(vectors["vec_id"].cast("long").alias("id"), vectors["embedding"].cast("array<float>").alias("v")).where("id is not null and v is not null and size(v) > 0")
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    v = v.where(usable)
    sizes = v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dimension = sizes["d"] if sizes else 1
    # 0.0 for -0.0, which is equal to it
    v = v.where(F.size("v") == dimension).select("id", F.transform("v", lambda x: x + F.lit(0.0).cast("float")).alias("v"))
    v = v.withColumn("key1", F.xxhash64("v")).withColumn("key2", F.xxhash64(F.lit(1), "v"))
    own = v.groupBy("id").agg(F.min(F.struct("key1", "key2")).alias("key")).select("id", "key.*")
    equal = cut(own.groupBy("key1", "key2").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")))
    firsts = equal.select(F.col("first").alias("id"), "key1", "key2", "copies")

    def as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v")).reshape(batch.num_rows, dimension)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key1"), batch.column("copies"), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "key1", "weight", "payload"])

    entries = cut(v.join(firsts, ["id", "key1", "key2"]).dropDuplicates(["id"]).select("id", "key1", "copies", "v").mapInArrow(as_bytes, "id long, key1 long, weight long, payload binary"))
    chosen = [r["payload"] for r in entries.orderBy("key1", "id").limit(sample).select("payload").collect()]
    p = np.frombuffer(b"".join(chosen), np.float32).reshape(-1, dimension).astype(np.float64)
    p = spread_out((p / np.linalg.norm(p, axis=1, keepdims=True)).astype(np.float32), min(pivots, max(32, len(p) // 4)))
    k = min(nearest, len(p))
    enough = min(min_shared, k)
    known = vectors.sparkSession.sparkContext.broadcast(p)
    i, j = np.triu_indices(max(0, k - enough + 2), 1)
    i, j = i[j < k], j[j < k]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS_AT_ONCE):
                batch = whole.slice(at, _ROWS_AT_ONCE)
                x = _rows(batch.column("payload"), np.float32, dimension)
                x = x / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True).astype(np.float32)
                near = nearest_pivots(x, known.value, k).astype(np.int16)
                by_number = np.sort(near, axis=1).astype(np.int32)
                of = pa.array(np.repeat(np.arange(len(near)), len(i)))
                code = pa.array([r.tobytes() for r in near], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array((by_number[:, i] << 16 | by_number[:, j]).reshape(-1)), batch.column("id").take(of), code.take(of)], ["pivots", "id", "near"])

    lists = in_blocks(entries.select("id", "payload").mapInArrow(describe, "pivots int, id long, near binary"), "pivots", F.col("near"), list_at_once)
    found = cut(lists.mapInArrow(_retrieve(k, enough, most_displaced), "a long, b long"))
    near = classes(linked(found, lambda needed: needed.join(entries, "id"), _similar(threshold, dimension), pairs_at_once)).withColumnRenamed("id", "first")
    rows = own.join(equal, ["key1", "key2"]).join(near, "first", "left")
    out = cut(rows.select(F.col("id").alias("vec_id"), F.coalesce("class_id", "first").alias("class_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")).where("n_links > 0"))
    for done in (equal, entries, found):
        drop_cut(done)
    return out
