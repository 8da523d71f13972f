"""Groups that buckets connect and links do not: links across them, and what is read to find them."""

import numpy as np
import pyarrow as pa

from tickloom.llm import near_dup
from tickloom.llm.near_dup import Banding, linked
from tickloom.llm.text import ngram_hashes

BANDING = Banding(rows=4, bands=20)


def _sets():
    """A hub's and two other sets, these alike: hashes on both sides of the signed zero."""
    values = np.sort(ngram_hashes(np.arange(1, 301, dtype=np.uint64), 1))
    assert (values.view(np.int64) < 0).any() and (values.view(np.int64) > 0).any()
    return {1: values[:120], 2: values[100:220], 3: np.concatenate([values[100:215], values[290:295]])}


def _sketched(spark):
    """Ids 2 and 3 share no bucket but that of band 0, whose hub is id 1; ids 4 and on make it the hub."""
    rng = np.random.default_rng(7)
    grid = {n: rng.integers(1, 60_000, (20, 4)) for n in range(1, 10)}
    grid[3][:, :3] = grid[2][:, :3]
    grid[2][0] = grid[3][0] = grid[1][0]
    for n in range(4, 10):
        grid[n][n] = grid[1][n]
    rows = [(n, 120, bytearray(r.astype(np.uint16).tobytes())) for n, r in grid.items()]
    return spark.createDataFrame(rows, "id long, n_shingles long, registers binary")


def test_links_between_members_that_are_not_hubs(spark):
    sets = _sets()
    others = {n: ngram_hashes(np.arange(1000 * n, 1000 * n + 120, dtype=np.uint64), 1) for n in range(4, 10)}
    frame = spark.createDataFrame(
        [(n, np.sort(s).view(np.int64).tolist()) for n, s in (sets | others).items()], "id long, shingles array<long>"
    )
    found = linked(_sketched(spark), lambda wanted: frame.join(wanted, "id"), BANDING)
    assert sorted((r.id, r.component) for r in found.collect()) == [(2, 2), (3, 2)]


def test_pairs_by_registers_are_those_of_each_pair():
    rng = np.random.default_rng(3)
    for buckets in (80, 200, 300):
        banding = Banding(rows=4, bands=buckets // 4)
        rows = rng.integers(0, 2, (90, buckets)).astype(np.uint16)
        sizes, components = rng.integers(60, 100, 90), rng.integers(0, 9, 90)
        stray = rng.random(90) < 0.4
        table = pa.RecordBatch.from_pydict({
            "outlier": stray, "n_shingles": sizes, "component": components,
            "registers": pa.array([r.tobytes() for r in rows], pa.binary()),
        })
        wanted = {
            (a, b) for a in np.flatnonzero(stray).tolist() for b in np.flatnonzero(~stray).tolist()
            if (rows[a] == rows[b]).sum() * 2 >= buckets and components[a] != components[b]
            and 100 * min(sizes[a], sizes[b]) >= 75 * max(sizes[a], sizes[b])
        }
        one, other = near_dup._near(table, banding)
        assert wanted and set(zip(one.tolist(), other.tolist(), strict=True)) == wanted


def test_groups_that_span_batches_are_whole(spark):
    frame = spark.range(400).selectExpr("id % 7 AS g", "id % 3 AS h", "id").coalesce(3)

    def summed(batch):
        return pa.RecordBatch.from_pydict({
            "g": batch.column("g").slice(0, 1), "h": batch.column("h").slice(0, 1),
            "rows": pa.array([batch.num_rows], pa.int64()), "ids": pa.array([sum(batch.column("id").to_pylist())], pa.int64()),
        })

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        found = near_dup._by_group(frame, ["g", "h"], summed, "g long, h long, rows long, ids long").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    wanted = {}
    for n in range(400):
        rows, ids = wanted.get((n % 7, n % 3), (0, 0))
        wanted[n % 7, n % 3] = (rows + 1, ids + n)
    assert len(found) == 21 and {(r.g, r.h): (r.rows, r.ids) for r in found} == wanted
