"""Fingerprints and their links against brute force, and edge cases."""

import os
import re

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tickloom.llm import simhash
from tickloom.llm.queries import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
_LOWER = str.maketrans({chr(65 + n): chr(97 + n) for n in range(26)})


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
    shingles = [" ".join(words[k: k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(bits):
    """Smallest row number reachable over all pairs."""
    bits = np.array(bits, np.uint64)
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= 4
    top = np.arange(len(bits))
    while True:
        new = np.array([top[row].min() for row in near])
        if (new == top).all():
            return top.tolist()
        top = new


def test_whole_query(spark):
    rows = sorted(duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall())
    bits = [fingerprint(t) for _, t in rows]
    expected = {(i, f"{b:016x}", rows[top][0]) for (i, _), b, top in zip(rows, bits, components(bits), strict=True)}
    assert {tuple(r) for r in all_queries()["op11_simhash"](spark, SF_DIR).collect()} == expected


def test_masks_cover_every_pair_within_the_radius():
    masks = [m % (1 << 64) for m in simhash.masks()]
    assert len(masks) == 31 and all(30 <= m.bit_count() <= 36 for m in masks)
    random = np.random.default_rng(1)
    for _ in range(5000):
        differing = sum(1 << int(b) for b in random.choice(64, 4, replace=False))
        assert any(not m & differing for m in masks)


@pytest.mark.parametrize("bucket", [2, 10, simhash.BUCKET])
def test_links_whatever_the_size_of_buckets(spark, bucket):
    """Groups whose members drift away from each other, so that buckets span several components."""
    random = np.random.default_rng(7)
    bits = []
    for centre in random.integers(0, 1 << 63, 6).tolist():
        bits.append(centre)
        for _ in range(40):
            step = bits[-1 if random.random() < 0.5 else random.integers(-10, 0) if len(bits) > 10 else -1]
            for b in random.choice(64, random.integers(1, 8), replace=False).tolist():
                step ^= 1 << b
            bits.append(step)
    bits = sorted({b - (1 << 64) if b >> 63 else b for b in bits})
    frame = spark.createDataFrame([(b,) for b in bits], "bits long")
    found = {r.id: r.component for r in simhash.linked(frame, bucket=bucket).collect()}
    tops = components([b % (1 << 64) for b in bits])
    groups = {b: bits[top] for b, top in zip(bits, tops, strict=True)}
    sizes = {top: tops.count(top) for top in tops}
    assert found == {b: groups[b] for b, top in zip(bits, tops, strict=True) if sizes[top] > 1}


def test_edges(spark):
    prose = " ".join(f"word{n}" for n in range(300))
    long = " ".join(f"w{n % 5000}" for n in range(200_000))
    rows = [
        (4, None), (3, ""), (9, " \t\n"), (5, prose), (5, prose), (6, prose.upper()), (7, "one two"), (8, "ONE\ttwo"),
        (None, prose), (None, None), (7, "another text of this id"), (10, long), (11, "é\x00 ü ▁ 日本"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("bits", "fingerprint", "component", "component_id", "id", "table", "key", "a", "b", "n", "own_id"):
        docs = docs.withColumn(name, F.lit("mine"))
    found = simhash.simhash_duplicates(docs).collect()
    top = {4: 3, 3: 3, 9: 3, 5: 5, 6: 5, 7: 7, 8: 7, 10: 10, 11: 11, None: None}
    assert sorted(map(repr, ((r.doc_id, r.fingerprint, r.component_id) for r in found))) == sorted(
        repr((i, f"{fingerprint(t):016x}", top[i])) for i, t in rows
    )
    assert simhash.simhash_duplicates(docs.where("false")).count() == 0
