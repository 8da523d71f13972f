"""Bit-plane arithmetic against plain whole numbers, and edge cases; the query has SQL."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import bitplanes

SCHEMA = "vec_id long, embedding array<float>, label int"


def test_products_and_distances():
    random = np.random.default_rng(2)
    for planes in (1, 2, 9, 28):
        ends = (-(1 << (planes - 1)), (1 << (planes - 1)) - 1)
        values = random.integers(ends[0], ends[1] + 1, (50, 64))
        values[0], values[1] = ends
        rows = bitplanes.packed(values, planes)
        assert (bitplanes.unpacked(rows) == values).all()
        centroids = values[[0, 1, 7, 7]]
        packed = bitplanes.packed(centroids, planes)
        assert (bitplanes.dots(rows, packed[2]) == values @ centroids[2]).all()
        assert (bitplanes.squares(rows) == (values * values).sum(axis=1)).all()
        exact = [[sum((int(x) - int(y)) ** 2 for x, y in zip(v, c)) for c in centroids] for v in values]
        own, distance = bitplanes.nearest(rows, bitplanes.squares(rows), packed)
        assert own.tolist() == [e.index(min(e)) for e in exact] and distance.tolist() == [min(e) for e in exact]


def brute(rows, clusters=8, rounds=10):
    kept = [
        (i, [math.floor(1024 * x) for x in v]) for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    digest = lambda i: hashlib.sha256(f"3:{i}".encode()).hexdigest()
    starts = sorted((digest(i), v) for i, v in kept if i is not None)[:clusters]
    centroids = [v for _, v in starts]
    square = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c))
    for step in range(rounds + 1):
        own = [min(range(len(centroids)), key=lambda c: (square(v, centroids[c]), c)) for _, v in kept]
        if step < rounds:
            for c in range(len(centroids)):
                if held := [v for (_, v), o in zip(kept, own) if o == c]:
                    centroids[c] = [sum(x) // len(held) for x in zip(*held)]
    found = [(i, o, square(v, centroids[o])) for (i, v), o in zip(kept, own)]
    inertia = [sum(d for _, o, d in found if o == c) for c in range(len(centroids))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, o, d, inertia[o], sum(inertia), digests[o]) for i, o, d in found), key=repr)


def clustered(spark, rows):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    for name in ("planes", "length", "cluster", "place", "total", "distance", "whole"):
        frame = frame.withColumn(name, F.lit("mine"))
    return sorted((tuple(r) for r in bitplanes.clustering(frame).collect()), key=repr)


def test_edges(spark):
    random = np.random.default_rng(4)
    some = [(n, random.normal(size=64).astype(np.float32).tolist()) for n in range(60)]
    same = [0.5] * 64
    odd = [
        (100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [None] + [1.0] * 63),
        (105, [math.nan] + [1.0] * 63), (106, [-math.inf] + [1.0] * 63), (None, same), (None, same), (7, same), (7, same),
        (107, [0.0] * 64), (108, [-0.0] * 64), (109, [1e-9] * 64), (110, [-1e-9] * 64), (111, [100_000.0] * 64),
    ]
    for rows in (some + odd, some[:3], [(1, same)] * 12, [(5, [0.0] * 64)]):
        assert clustered(spark, rows) == brute(rows)
    assert clustered(spark, [(1, None)]) == [] and clustered(spark, []) == []
    assert [r[:3] for r in clustered(spark, [(None, [0.0] * 64)])] == [(None, 0, 0)]
    with pytest.raises(ValueError, match="bits"):
        clustered(spark, [(1, [1e30] * 64)])
