"""Centroid clustering with exact distances from bit planes.

A vector of 64 whole components is packed into bit planes: plane p is one 64-bit number that
holds bit p of every component, in two's complement, so the last plane counts negative. The
dot product of two vectors is the sum over pairs of planes of their weights times the
population count of the planes' AND; squared distances follow from it. All of it is whole
numbers, hence the same on every machine and in any order.

Vectors are packed once and written; every round reads the planes only. Tasks assign their
vectors and hand over, per cluster, how many there are and the sums of the components, which
Spark adds up; the driver sees one number per cluster and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.store import Scratch, written

WIDTH = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
#: Bits of a component: squared distances of 64 components still fit into 64 bits.
MOST_BITS = 28

#: Vectors worked on at once.
_ROWS = 1 << 13


def usable(column: str) -> Column:
    """Whether a vector has as many components as a plane has bits, none null or non-finite."""
    good = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(column) == WIDTH) & good, F.lit(False))


def packed(components: np.ndarray, planes: int) -> np.ndarray:
    """Whole components, a vector a row, to one row of planes per vector."""
    bits = (components[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view(np.uint64)[:, :, 0]


def weights(planes: int) -> np.ndarray:
    out = np.int64(1) << np.arange(planes, dtype=np.int64)
    out[-1] = -out[-1]
    return out


def unpacked(rows: np.ndarray) -> np.ndarray:
    """The components behind rows of planes."""
    bits = np.unpackbits(np.ascontiguousarray(rows).view(np.uint8).reshape(*rows.shape, 8), axis=2, bitorder="little")
    return np.einsum("p,npw->nw", weights(rows.shape[1]), bits.astype(np.int64))


def dots(rows: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Dot products of rows of planes with the planes of one centroid."""
    weight = weights(rows.shape[1])
    columns = np.ascontiguousarray(rows.T)
    out = np.zeros(len(rows), np.int64)
    for q, plane in enumerate(centroid):
        if not plane:
            continue
        part = np.zeros(len(rows), np.int64)
        for p, column in enumerate(columns):
            part += weight[p] * np.bitwise_count(column & plane).astype(np.int64)
        out += weight[q] * part
    return out


def squares(rows: np.ndarray) -> np.ndarray:
    """The squared length of each row of planes."""
    weight, out = weights(rows.shape[1]), np.zeros(len(rows), np.int64)
    for p in range(rows.shape[1]):
        out += weight[p] * weight[p] * np.bitwise_count(rows[:, p]).astype(np.int64)
        for q in range(p):
            out += 2 * weight[p] * weight[q] * np.bitwise_count(rows[:, p] & rows[:, q]).astype(np.int64)
    return out


def nearest(rows: np.ndarray, lengths: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid, ties to the smaller, and the squared distance to it."""
    distances = np.stack([lengths - 2 * dots(rows, c) for c in centroids]) + squares(centroids)[:, None]
    own = np.argmin(distances, axis=0)
    return own, distances[own, np.arange(len(rows))]


def _bits(vectors: DataFrame) -> int:
    """How many bits the components take, by the least and the largest of all."""
    scaled = lambda x: x.cast("double") * SCALE
    # As floating point: what is far too large fits no whole number.
    ends = vectors.agg(
        F.min(scaled(F.array_min("embedding"))).alias("low"), F.max(scaled(F.array_max("embedding"))).alias("high")
    ).first()
    if ends.low is None:
        return 1
    reach = max(-np.floor(ends.low), np.floor(ends.high) + 1, 1.0)
    if reach > 2.0 ** (MOST_BITS - 1):
        raise ValueError(f"components reach {reach:.0f} after scaling; {MOST_BITS} bits are the most")
    return int(reach - 1).bit_length() + 1


def _planes_of(column: pa.Array) -> np.ndarray:
    flat = np.frombuffer(b"".join(column.to_pylist()), np.uint64)
    return flat.reshape(len(column), -1)


def packed_table(vectors: DataFrame, planes: int) -> DataFrame:
    """(vec_id, planes, length): bit planes, and the squared length, of ``embedding``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, _ROWS):
                part = batch.slice(low, _ROWS)
                values = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                rows = packed(np.floor(values * SCALE).astype(np.int64).reshape(-1, WIDTH), planes)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([r.tobytes() for r in rows], pa.binary()), pa.array(squares(rows))],
                    names=["vec_id", "planes", "length"],
                )

    return vectors.select("vec_id", "embedding").mapInArrow(work, "vec_id long, planes binary, length long")


def first_centroids(vectors: DataFrame, count: int, planes: int) -> np.ndarray:
    """Planes of the vectors whose ids come first by digest; rows of one id by their components."""
    digest = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    chosen = (
        vectors.where("vec_id IS NOT NULL").select(digest.alias("digest"), whole.alias("whole"))
        .orderBy("digest", "whole").limit(count).collect()
    )
    return packed(np.array([r.whole for r in chosen], np.int64).reshape(-1, WIDTH), planes)


def moved(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after a round: the floor of the mean of each one's vectors; one without stays."""
    shape = (len(centroids), centroids.shape[1], WIDTH)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ones, counts = np.zeros(shape, np.int64), np.zeros(len(centroids), np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, _ROWS):
                part = batch.slice(low, _ROWS)
                rows = _planes_of(part.column(0))
                own, _ = nearest(rows, part.column(1).to_numpy(), centroids)
                counts += np.bincount(own, minlength=len(centroids))
                for c in np.unique(own):
                    bits = np.ascontiguousarray(rows[own == c]).view(np.uint8).reshape(-1, shape[1], 8)
                    ones[c] += np.unpackbits(bits, axis=2, bitorder="little").sum(axis=0, dtype=np.int64)
        sums = np.einsum("p,cpw->cw", weights(shape[1]), ones)
        held = np.flatnonzero(counts)
        if len(held):
            # The count stands after the components.
            totals = np.concatenate([sums, counts[:, None]], axis=1)[held]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(held, WIDTH + 1), pa.int32()),
                    pa.array(np.tile(np.arange(WIDTH + 1), len(held)), pa.int32()), pa.array(totals.ravel()),
                ],
                names=["cluster", "place", "total"],
            )

    parts = table.select("planes", "length").mapInArrow(work, "cluster int, place int, total long")
    totals: dict[tuple[int, int], int] = {
        (r.cluster, r.place): r.total
        for r in parts.groupBy("cluster", "place").agg(F.sum("total").alias("total")).collect()
    }
    whole = unpacked(centroids)
    for c in range(len(whole)):
        if count := totals.get((c, WIDTH)):
            whole[c] = [totals[c, place] // count for place in range(WIDTH)]
    return packed(whole, centroids.shape[1])


def assigned(table: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance): each vector's nearest centroid and the squared distance to it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, _ROWS):
                part = batch.slice(low, _ROWS)
                own, distance = nearest(_planes_of(part.column(1)), part.column(2).to_numpy(), centroids)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(own, pa.int32()), pa.array(distance)],
                    names=["vec_id", "cluster", "distance"],
                )

    return table.select("vec_id", "planes", "length").mapInArrow(work, "vec_id long, cluster int, distance long")


def centroid_digest(components: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, components.tolist())).encode()).hexdigest()


def clustering(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of vectors (vec_id, embedding).

    A component x counts as floor(1024 * x). Vectors that are null, of another length than 64 or
    with components that are null or not finite have no row; all others have one each, rows of
    one vec_id and those without too. A row without vec_id does not start a centroid. Fewer
    vectors than clusters make fewer clusters. Components of a magnitude of 131,072 or more
    are an error, as distances would not fit their type. Other columns are not read.
    """
    kept = vectors.select(F.col("vec_id").cast("long"), "embedding").where(usable("embedding"))
    planes = _bits(kept)
    centroids = first_centroids(kept, clusters, planes)
    with Scratch(vectors.sparkSession) as scratch:
        table = scratch.write(packed_table(kept, planes), "bit-planes")
        if not len(centroids):
            # No vector, or none with an id: one centroid at the origin.
            centroids = np.zeros((1, planes), np.uint64)
        for _ in range(rounds):
            centroids = moved(table, centroids)
        rows = written(assigned(table, centroids), "clusters")
    sums = {r.cluster: r.total for r in rows.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    of_cluster = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)
    inertia = [sums.get(c, 0) for c in range(len(centroids))]
    return rows.select(
        "vec_id", "cluster", "distance", of_cluster(inertia).cast("long").alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("long").alias("inertia"),
        of_cluster([centroid_digest(c) for c in unpacked(centroids)]).alias("centroid_sha256"),
    )
