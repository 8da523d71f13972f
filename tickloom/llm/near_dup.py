"""Near-duplicate texts by HyperMinHash.

A text is its set of word shingles. The shingles' hashes fall into buckets; a bucket's
register holds the count of leading zeros of its smallest hash and the mantissa bits that
follow: 16 bits in all. Bands of registers bring together the texts to compare; the share
of equal registers, corrected for collisions, estimates their Jaccard similarity; pairs
that may pass are verified on their full sets. Linked texts form components.

Equal sets are one class from the start. Within a band's bucket each class is compared
with one hub, so a bucket of any size costs a row per class. Where buckets span several
components afterwards, the classes outside the largest one are compared with all others, in
blocks, by their registers and then on full sets, so that no link that the bands find is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.llm.components import connected
from tickloom.llm.frames import tidy
from tickloom.llm.store import Scratch, written
from tickloom.llm.text import long_lists, mix, raw_texts, shingle_sets, slices

_U64 = np.uint64
MANTISSA_BITS = 10
#: Classes in a block, about, where those of large groups are compared with each other.
BLOCK = 512


@dataclass(frozen=True)
class Banding:
    """At similarity s a pair shares no band with probability (1 - s**rows)**bands."""

    rows: int = 5
    bands: int = 40
    words: int = 5
    percent: int = 75
    #: Pairs whose estimate is below are not verified; ten standard deviations of the
    #: estimate under the threshold at the usual number of registers.
    least_estimate: float = 0.5

    @property
    def buckets(self) -> int:
        return self.rows * self.bands


def _orders(buckets: int) -> np.ndarray:
    """For each bucket an order of all buckets in which an empty one looks for another's register."""
    grid = np.arange(buckets * buckets, dtype=_U64).reshape(buckets, buckets)
    return np.argsort(np.argsort(mix(grid + _U64(1)), axis=1), axis=1).astype(np.int32)


_cache: dict[int, np.ndarray] = {}


def registers(values: np.ndarray, first: np.ndarray, buckets: int) -> np.ndarray:
    """HyperMinHash registers of sets of sorted hashes: a row of 16-bit registers per set.

    A bucket that no hash falls into takes over the register of the first filled bucket
    in an order of its own, so that small sets keep the chance of equal registers equal to
    their similarity. An empty set has registers of zeros.
    """
    if buckets not in _cache:
        _cache[buckets] = _orders(buckets)
    orders = _cache[buckets]
    count = len(first) - 1
    size = _U64(buckets)
    # The upper half of hash x buckets is the bucket; what is left orders hashes within it.
    bucket = ((values >> _U64(32)) * size + (((values & _U64(0xFFFFFFFF)) * size) >> _U64(32))) >> _U64(32)
    owner = np.repeat(np.arange(count), np.diff(first))
    place = owner * buckets + bucket.astype(np.int64)
    lead = np.ones(len(place), bool)
    np.not_equal(place[1:], place[:-1], out=lead[1:])
    lead = np.flatnonzero(lead)
    rest = (values[lead] * size).astype(np.float64)
    part, exponent = np.frexp(np.maximum(rest, 1.0))
    # A smaller hash has more leading zeros, then a smaller mantissa: codes keep the order.
    code = (exponent.astype(np.int64) << MANTISSA_BITS) | ((part - 0.5) * (2 << MANTISSA_BITS)).astype(np.int64)
    out = np.zeros(count * buckets, np.uint16)
    filled = np.zeros(count * buckets, bool)
    out[place[lead]] = code
    filled[place[lead]] = True
    out, filled = out.reshape(count, buckets), filled.reshape(count, buckets)
    for text in np.flatnonzero((~filled).any(axis=1) & filled.any(axis=1)):
        have = np.flatnonzero(filled[text])
        lack = np.flatnonzero(~filled[text])
        source = have[np.argmin(orders[lack[:, None], have[None, :]], axis=1)]
        out[text, lack] = out[text, source]
    return out


def band_keys(rows: np.ndarray, banding: Banding) -> np.ndarray:
    """A 64-bit key for each band of each row of registers."""
    split = rows.reshape(len(rows), banding.bands, banding.rows).astype(_U64)
    key = np.broadcast_to(np.arange(1, banding.bands + 1, dtype=_U64) * _U64(0x9E3779B97F4A7C15), split.shape[:2])
    for row in range(banding.rows):
        key = mix(key + split[:, :, row])
    return key


def collision_chance(size_a: np.ndarray, size_b: np.ndarray, buckets: int) -> np.ndarray:
    """Chance that registers of two sets without common members are equal.

    Within an octave of leading zeros the smallest hash is nearly uniform over the mantissa,
    so the chance is the product of both octave chances over the number of mantissas.
    """
    rate_a, rate_b = (np.asarray(s, float)[:, None] / buckets for s in (size_a, size_b))
    upper = 2.0 ** -np.arange(0, 54)
    in_a = np.exp(-rate_a * upper / 2) - np.exp(-rate_a * upper)
    in_b = np.exp(-rate_b * upper / 2) - np.exp(-rate_b * upper)
    return (in_a * in_b).sum(axis=1) / (1 << MANTISSA_BITS)


def estimates(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of the sets behind rows of registers, without chance collisions."""
    chance = collision_chance(size_a, size_b, a.shape[1])
    return ((a == b).mean(axis=1) - chance) / (1 - chance)


def sketches(docs: DataFrame, banding: Banding, id_column: str = "doc_id") -> DataFrame:
    """(id, n_shingles, set_id, registers): set_id is a 128-bit digest of the full set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw_texts(batch.column(1))
            for low, high in slices(texts):
                sets = shingle_sets(texts[low:high], banding.words)
                rows = registers(sets.values, sets.first, banding.buckets)
                counts = sets.counts
                sums = np.zeros((2, len(sets.values) + 1), _U64)
                for part in range(2):
                    np.cumsum(mix(sets.values + _U64(part * 0x5851F42D4C957F2D)), out=sums[part, 1:])
                digest = sums[:, sets.first[1:]] - sums[:, sets.first[:-1]]
                digest[0] += counts.astype(_U64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array(counts, pa.int64()),
                        pa.array([d.tobytes() for d in np.ascontiguousarray(digest.T)], pa.binary()),
                        pa.array([r.tobytes() for r in rows], pa.binary()),
                    ],
                    names=["id", "n_shingles", "set_id", "registers"],
                )

    return docs.select(F.col(id_column).cast("long").alias("id"), F.col("text").cast("string")).mapInArrow(
        tidy(work), "id long, n_shingles long, set_id binary, registers binary"
    )


def _registers(column: pa.Array, buckets: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, buckets)


def banded(sketched: DataFrame, banding: Banding) -> DataFrame:
    """(key, id): the key of each band of each sketch."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = band_keys(_registers(batch.column(1), banding.buckets), banding)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.ascontiguousarray(keys).reshape(-1).view(np.int64)),
                    batch.column(0).take(pa.array(np.repeat(np.arange(len(keys)), banding.bands))),
                ],
                names=["key", "id"],
            )

    return sketched.select("id", "registers").mapInArrow(tidy(work), "key long, id long")


def full_sets(docs: DataFrame, n: int, id_column: str = "doc_id") -> DataFrame:
    """(id, shingles): the sorted distinct shingles of each whole text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw_texts(batch.column(1))
            for low, high in slices(texts):
                sets = shingle_sets(texts[low:high], n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), long_lists(sets.values, sets.first)],
                    names=["id", "shingles"],
                )

    return docs.select(F.col(id_column).cast("long").alias("id"), F.col("text").cast("string")).mapInArrow(
        tidy(work), "id long, shingles array<long>"
    )


def plausible(pairs: DataFrame, sketched: DataFrame, banding: Banding) -> DataFrame:
    """Pairs (a, b) whose sizes and estimate leave the threshold in reach."""
    percent, least, buckets = banding.percent, banding.least_estimate, banding.buckets

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows_a, rows_b = (_registers(batch.column(c), buckets) for c in (2, 3))
            size_a, size_b = (batch.column(c).to_numpy(zero_copy_only=False) for c in (4, 5))
            keep = estimates(rows_a, rows_b, size_a, size_b) >= least
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(keep)) for c in (0, 1)], names=["a", "b"]
            )

    side = lambda name: sketched.select(
        F.col("id").alias(name), F.col("registers").alias(f"r_{name}"), F.col("n_shingles").alias(f"n_{name}")
    )
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    met = met.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return met.select("a", "b", "r_a", "r_b", "n_a", "n_b").mapInArrow(tidy(work), "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are alike enough: 100 x intersection >= percent x union."""
    side = lambda name: sets.select(F.col("id").alias(name), F.col("shingles").alias(f"s_{name}"))
    common: Column = F.size(F.array_intersect("s_a", "s_b"))
    both = F.size("s_a") + F.size("s_b")
    return (
        pairs.join(side("a"), "a").join(side("b"), "b")
        .select("a", "b", common.alias("common"), both.alias("both"))
        .where(100 * F.col("common") >= percent * (F.col("both") - F.col("common")))
        .select("a", "b").distinct()
    )


def _torn(members: DataFrame, found: DataFrame) -> DataFrame:
    """(key, id, component) of the buckets that span several components, written."""
    with Scratch(members.sparkSession) as scratch:
        # Read twice.
        labelled = scratch.write(
            members.select("key", "id").join(found, "id", "left").select(
                "key", "id", F.coalesce("component", "id").alias("component")
            ),
            "labelled-members",
        )
        spans = labelled.groupBy("key").agg(F.min("component").alias("c1"), F.max("component").alias("c2"))
        return written(labelled.join(spans.where("c1 <> c2").select("key"), "key"), "torn-buckets")


def _to_hubs(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of each bucket's hub and its members of other components.

    The hub is the member that shares buckets with most others, ties to the smaller id: in
    a group of copies of one text that is most likely the text they were copied from.
    """
    sizes = members.groupBy("key").agg(F.count("*").alias("size"))
    degrees = members.join(sizes, "key").groupBy("id").agg(F.sum("size").alias("degree"))
    ranked = members.join(degrees, "id")
    hubs = ranked.groupBy("key").agg(F.max(F.struct("degree", (-F.col("id")).alias("back"), "component")).alias("hub"))
    return (
        members.join(hubs, "key").where("component <> hub.component")
        .select((-F.col("hub.back")).alias("hub"), "id")
        .select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b")).distinct()
    )


def _near(table: pa.RecordBatch, banding: Banding) -> tuple[np.ndarray, np.ndarray]:
    """Places of outliers, and of others of a group, that differ in component and whose sizes and registers
    leave the threshold in reach; to correct registers for collisions would only rule out more."""
    stray, sizes, components = (table[c].to_numpy(zero_copy_only=False) for c in ("outlier", "n_shingles", "component"))
    rows = _registers(table["registers"], banding.buckets)
    ones, others = np.flatnonzero(stray), np.flatnonzero(~stray)
    if len(ones) * len(others) <= 256:
        equal = np.count_nonzero(rows[ones][:, None] == rows[others], axis=2)
    else:
        # One register of all pairs at a time.
        own, their = np.ascontiguousarray(rows[ones].T), np.ascontiguousarray(rows[others].T)
        equal = np.zeros((len(ones), len(others)), np.uint8 if banding.buckets < 256 else np.uint32)
        same = np.empty(equal.shape, bool)
        for one, other in zip(own, their, strict=True):
            np.equal(one[:, None], other, out=same)
            equal += same.view(np.uint8)
    one, other = np.nonzero(equal >= banding.least_estimate * banding.buckets)
    one, other = ones[one], others[other]
    keep = components[one] != components[other]
    keep &= 100 * np.minimum(sizes[one], sizes[other]) >= banding.percent * np.maximum(sizes[one], sizes[other])
    return one[keep], other[keep]


def _alike(table: pa.RecordBatch, banding: Banding) -> pa.RecordBatch:
    """Links between the outliers and the others of a group, where components differ, by their full sets."""
    ids, sets = table["id"].to_numpy(), table["shingles"]
    # Hashes are unsigned; as such they are in order.
    held = [np.asarray(values, np.int64).view(_U64) for values in sets.to_numpy(zero_copy_only=False)]
    one, other = _near(table, banding)
    found: list[np.ndarray] = []
    for part in np.split(np.arange(len(one)), np.flatnonzero(np.diff(one)) + 1) if len(one) else []:
        values, members = held[one[part[0]]], other[part]
        sizes = np.array([len(held[m]) for m in members.tolist()])
        # How many of its own shingles each of the likely ones has, all of them looked up at once.
        joined = np.concatenate([held[m] for m in members.tolist()])
        place = np.minimum(np.searchsorted(values, joined), len(values) - 1)
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        common = np.add.reduceat((values[place] == joined).astype(np.int64), first)
        found.append(part[100 * common >= banding.percent * (len(values) + sizes - common)])
    good = np.concatenate([*found, np.zeros(0, np.int64)]).astype(np.int64)
    a, b = ids[one[good]], ids[other[good]]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], names=["a", "b"]
    )


def _by_group(
    frame: DataFrame, keys: list[str], work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType
) -> DataFrame:
    """What ``work`` makes of each group; for many small groups, as a call of Python for each costs more than its work."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []  # of the group that the last batch ended with
        for batch in batches:
            if not batch.num_rows:
                continue
            values = [batch.column(k).to_numpy() for k in keys]
            edges = np.flatnonzero(np.logical_or.reduce([v[1:] != v[:-1] for v in values])) + 1
            if kept and any(kept[-1].column(k)[-1] != batch.column(k)[0] for k in keys):
                yield _made(kept)
                kept = []
            start = 0
            for stop in edges.tolist():
                yield _made([*kept, batch.slice(start, stop - start)])
                kept, start = [], stop
            kept.append(batch.slice(start))
        if kept:
            yield _made(kept)

    def _made(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return work(parts[0] if len(parts) == 1 else pa.concat_batches(parts))

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches of some thousand rows, not one for each group."""
        held, rows = [], 0
        for made in run(batches):
            if made.num_rows:
                held.append(made)
                rows += made.num_rows
            if rows >= 4096:
                yield pa.concat_batches(held)
                held, rows = [], 0
        if held:
            yield pa.concat_batches(held)

    return frame.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(tidy(full), schema)


def _across(torn: DataFrame, sketched: DataFrame, sets: DataFrame, banding: Banding) -> DataFrame:
    """Links (a, b) between components that still share buckets, written.

    Ids that torn buckets connect make up a group. The largest component of a group is
    settled within itself; ids outside of it, its outliers, are compared with all of the
    group, first by registers alone and, where these are alike, on full sets. Both sides are dealt
    into blocks and each pair of blocks is a task's group, from which only ids that have a likely
    partner, then links, come out; few outliers cost few copies of a row, however large the group.
    """
    lowest = torn.groupBy("key").agg(F.min("id").alias("low"))
    with Scratch(torn.sparkSession) as scratch:
        groups = connected(torn.join(lowest, "key").select(F.col("low").alias("a"), F.col("id").alias("b")).distinct())
        placed = scratch.write(
            torn.select("id", "component").distinct().join(groups.withColumnRenamed("component", "group"), "id"), "groups"
        )
        parts = placed.groupBy("group", "component").agg(F.count("*").alias("n"))
        shape = parts.groupBy("group").agg(F.sum("n").alias("members"), F.max(F.struct("n", "component")).alias("largest"))
        rows = placed.join(sketched.select("id", "n_shingles", "registers"), "id").join(shape, "group").select(
            "group", "id", "component", "n_shingles", "registers",
            (F.col("component") != F.col("largest.component")).alias("stray"),
            F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"),
            F.ceil((F.col("members") - F.col("largest.n")) / BLOCK).cast("int").alias("stray_blocks"),
        )
        rows = scratch.write(rows, "group-rows")  # read twice
        every = lambda count: F.sequence(F.lit(0), F.col(count) - 1)
        block = lambda count: F.expr(f"cast(pmod(xxhash64(id, '{count}'), {count}) as int)")
        pair = ["group", "block", "stray_block"]
        columns = [*pair, "outlier", "id", "component", "n_shingles", "registers"]
        others = rows.withColumn("block", block("blocks")).withColumn("stray_block", F.explode(every("stray_blocks")))
        strays = rows.where("stray").withColumn("stray_block", block("stray_blocks")).withColumn(
            "block", F.explode(every("blocks"))
        )
        both = others.withColumn("outlier", F.lit(False)).select(columns).unionByName(
            strays.withColumn("outlier", F.lit(True)).select(columns)
        )

        def with_partner(table: pa.RecordBatch) -> pa.RecordBatch:
            return table.take(pa.array(np.union1d(*_near(table, banding)).astype(np.int64)))

        near = scratch.write(_by_group(both, pair, with_partner, both.schema), "near")
        found = _by_group(near.join(sets, "id"), pair, lambda table: _alike(table, banding), "a long, b long")
        return written(found, "edges")


def linked(sketched: DataFrame, sets_of: Callable[[DataFrame], DataFrame], banding: Banding) -> DataFrame:
    """Components (id, component) of the classes of equal sets, written; ids without a link are left out.

    ``sketched`` holds one row per class; ``sets_of`` gives the shingles (id, shingles) of the
    full sets of those among the ids (``id``) of a written table.
    """
    with Scratch(sketched.sparkSession) as scratch:
        keyed = banded(sketched, banding)
        shared = keyed.groupBy("key").agg(F.min("id").alias("id1"), F.max("id").alias("id2")).where("id1 <> id2")
        members = scratch.write(keyed.join(shared.select("key"), "key"), "bucket-members")
        sets = scratch.write(sets_of(scratch.write(members.select("id").distinct(), "bucket-ids")), "sets")

        pairs = scratch.write(_to_hubs(members.withColumn("component", F.col("id"))), "pairs")
        edges = scratch.write(verified(plausible(pairs, sketched, banding), sets, banding.percent), "edges")
        found = connected(edges)
        torn = scratch.adopt(_torn(members, found))
        if not torn.isEmpty():
            more = scratch.adopt(_across(torn, sketched, sets, banding))
            if not more.isEmpty():
                stars = found.select(F.col("id").alias("a"), F.col("component").alias("b"))
                found = connected(stars.unionByName(more))
        return written(found, "components")


def near_duplicates(docs: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs (doc_id, text).

    ``component_id`` is the smallest doc_id of the linked texts; that one is kept.
    Texts that are null, empty or without words have no shingles and no links; a text of
    fewer words than a shingle has is compared as a whole. Rows of one doc_id count as one
    document. A null doc_id is in no component and kept. Other columns are not read.
    """
    with Scratch(docs.sparkSession) as scratch:
        every = scratch.write(sketches(docs, banding), "sketches")
        # One sketch of each class, that of its smallest id.
        classes = scratch.write(
            every.where("n_shingles > 0 AND id IS NOT NULL").groupBy("set_id").agg(
                F.min("id").alias("id"), F.max("id").alias("last_id"),
                F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"),
            ),
            "classes",
        )
        with_text = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string"))

        def sets_of(wanted: DataFrame) -> DataFrame:
            # The same join at every size: texts are never joined with a broadcast of ids.
            return full_sets(with_text.join(wanted.hint("merge"), "id", "left_semi"), banding.words, "id")

        found = scratch.adopt(linked(classes.select("id", "n_shingles", "registers"), sets_of, banding))
        copies = classes.where("id <> last_id").select("set_id", F.col("id").alias("first_id"))
        result = (
            every.select("id", "n_shingles", "set_id").join(copies, "set_id", "left")
            .withColumn("class_id", F.coalesce("first_id", "id"))
            .join(found.withColumnRenamed("id", "class_id"), "class_id", "left")
            .select(
                F.col("id").alias("doc_id"), "n_shingles",
                F.coalesce("component", "class_id").alias("component_id"),
            )
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
        )
        return written(result, "near-duplicates")
