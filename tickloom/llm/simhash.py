"""Near-duplicate texts by SimHash fingerprints and covering locality-sensitive hashing.

Each word shingle of a text, repeats included, has a 64-bit hash; a bit of the fingerprint is
set if it is set in over half of them. Fingerprints that differ in at most ``RADIUS`` bits
are linked.

To find them, every bit is given a vector over GF(2) with ``RADIUS + 1`` places. Each nonzero
vector v makes a table that keeps the bits whose vector has an odd product with v. The
vectors of up to ``RADIUS`` differing bits never span the whole space, so some v is
orthogonal to all of them: its table keeps none of these bits, and the pair collides there. No
pair within the radius is ever missed.

Equal fingerprints are one from the start. Of a bucket of two the pair is checked where it was
counted; larger ones, up to ``BUCKET`` fingerprints, are walked through by one task each, which
gives out links enough to connect what is linked. Fingerprints in still larger buckets meet at
the points half-way between them: every point within half the radius of a fingerprint is a
meeting place, and what meets is linked, so a group of any size costs a number of rows in
proportion and never gathers in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tickloom.llm.components import connected
from tickloom.llm.frames import tidy
from tickloom.llm.store import Scratch, written
from tickloom.llm.text import SPACED, Words, raw_texts, slices, words

SHINGLE = 4
SEED = 42
RADIUS = 4
#: Fingerprints in a bucket that one task walks through: 256 KB.
BUCKET = 1 << 15

#: Shingles whose bits are summed at once.
_CHUNK = 1 << 16


def _joined(found: Words) -> tuple[bytes, np.ndarray]:
    """All words with one space after each, and where each starts in that."""
    inside = np.zeros(len(found.data) + 1, np.int8)
    inside[found.starts] += 1
    inside[found.ends] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    keep = inside.copy()
    keep[found.ends] = True
    spaced = np.where(inside, found.data, np.uint8(0x20))[keep]
    return spaced.tobytes(), np.concatenate([[0], np.cumsum(found.ends - found.starts + 1)])


def shingle_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each text's shingles, one text after the other, and each text's first."""
    found = words(texts, SPACED)
    joined, starts = _joined(found)
    counts = found.counts
    runs = np.where(counts >= SHINGLE, counts - SHINGLE + 1, (counts > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(runs)])
    # Numbers of the first and the last word of each shingle; a short text is one as a whole.
    low = np.arange(first[-1]) + np.repeat(found.first[:-1] - first[:-1], runs)
    high = low + np.repeat(np.minimum(counts, SHINGLE), runs)
    begin, end = starts[low].tolist(), (starts[high] - 1).tolist()
    hashes = (xxh64_intdigest(joined[a:b], SEED) for a, b in zip(begin, end, strict=True))
    return np.fromiter(hashes, np.uint64, len(begin)), first


def majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per range of hashes the bits set in over half of them; of none, zero."""
    sums = np.zeros((len(first) - 1, 64), np.int64)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for low in range(0, len(hashes), _CHUNK):
        part = owner[low: low + _CHUNK]
        heads = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        bits = np.unpackbits(hashes[low: low + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums[part[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    over = 2 * sums > np.diff(first)[:, None]
    return np.packbits(over, axis=1, bitorder="little").reshape(-1, 8).view(np.uint64).reshape(-1)


def fingerprints(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, bits): the fingerprint of each row's ``text`` as a signed number."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw_texts(batch.column(1))
            for low, high in slices(texts):
                bits = majority(*shingle_hashes(texts[low:high]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(bits.view(np.int64))], names=["doc_id", "bits"]
                )

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(
        tidy(work), "doc_id long, bits long"
    )


def masks(radius: int = RADIUS) -> list[int]:
    """The kept bits of each table, as signed numbers; 2**(radius + 1) - 1 tables of about 32 bits."""
    every = (1 << (radius + 1)) - 1
    vectors = [1 + bit % every for bit in range(64)]
    kept = (sum(1 << bit for bit, v in enumerate(vectors) if (v & table).bit_count() % 2) for table in range(1, every + 1))
    return [m - (1 << 64) if m >> 63 else m for m in kept]


def _differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def spanning(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect whatever pairs within the radius connect; at most one per value."""
    links: list[tuple[int, int]] = []
    left = values.astype(np.int64)
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            centre = queue.pop()
            near = np.bitwise_count(left.view(np.uint64) ^ np.uint64(int(centre) % (1 << 64))) <= radius
            if near.any():
                found = left[near]
                links += [(int(centre), value) for value in found.tolist()]
                queue.extend(found)
                left = left[~near]
    return links


def _walked(buckets: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) within the lists ``members``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = [link for row in batch.column(0) for link in spanning(row.values.to_numpy(), radius)]
            if links:
                pairs = np.array(links, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return buckets.select("members").mapInArrow(tidy(work), "a long, b long")


def _met(hot: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) of fingerprints that meet at a point within half the radius of both.

    Two that differ in d bits have points half-way, so none within the radius is missed; the
    other way, what meets at a point differs by no more than twice the half.
    """
    if radius % 2:
        raise ValueError("the radius must be even: half-way points need whole bits")
    half = radius // 2
    steps = np.zeros(1, np.uint64)
    for _ in range(half):
        steps = np.unique(np.concatenate([steps, (steps[:, None] ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))).ravel()]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for low in range(0, len(values), 256):
                part = values[low: low + 256]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((part[:, None] ^ steps).ravel().view(np.int64)),
                        pa.array(np.repeat(part, len(steps)).view(np.int64)),
                    ],
                    names=["point", "bits"],
                )

    points = hot.mapInArrow(tidy(work), "point long, bits long")
    least = points.groupBy("point").agg(F.min("bits").alias("a"), F.max("bits").alias("last")).where("a <> last")
    return points.join(least.select("point", "a"), "point").where("a <> bits").select("a", F.col("bits").alias("b")).distinct()


def linked(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Components (id, component) of the linked fingerprints among the different ``bits``, written.

    Those without a link are left out. ``bucket`` is how large a bucket one task walks through.
    """
    tables = F.array(*[
        F.struct(F.lit(n).cast("byte").alias("table"), F.col("bits").bitwiseAND(F.lit(mask)).alias("key"))
        for n, mask in enumerate(masks(radius))
    ])
    keyed = distinct.select("bits", F.inline(tables))
    with Scratch(distinct.sparkSession) as scratch:
        sizes = scratch.write(
            keyed.groupBy("table", "key")
            .agg(F.min("bits").alias("a"), F.max("bits").alias("b"), F.count("*").alias("n")).where("n > 1"),
            "buckets",
        )
        pairs = sizes.where((F.col("n") == 2) & (_differing("a", "b") <= radius)).select("a", "b").distinct()
        more = sizes.where("n > 2").select("table", "key", "n")
        # The same join at every size: the keys of all fingerprints never meet a broadcast.
        members = scratch.write(keyed.join(more.hint("merge"), ["table", "key"]), "bucket-members")
        lists = members.where(F.col("n") <= bucket).groupBy("table", "key").agg(F.collect_list("bits").alias("members"))
        hot = members.where(F.col("n") > bucket).select("bits").distinct()
        edges = pairs.unionByName(_walked(lists, radius)).unionByName(_met(hot, radius))
        return written(connected(scratch.write(edges, "edges")), "components")


def simhash_duplicates(docs: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of docs (doc_id, text).

    ``fingerprint`` is 16 lower-case hex digits. ``component_id`` is the smallest doc_id that
    links lead to, its own included. A text that is null, empty or without words has the
    fingerprint zero and is linked like any other; a text of fewer words than a shingle is
    one shingle. Rows of one doc_id are linked only through their fingerprints. A row without
    doc_id has a fingerprint but no component, and links nothing. Other columns are not read.
    """
    with Scratch(docs.sparkSession) as scratch:
        every = scratch.write(fingerprints(docs), "fingerprints")
        classes = scratch.write(
            every.where("doc_id IS NOT NULL").groupBy("bits").agg(F.min("doc_id").alias("own_id")), "classes"
        )
        found = scratch.adopt(linked(classes.select("bits"), radius, bucket))
        labelled = classes.join(found.withColumnRenamed("id", "bits"), "bits", "left")
        label = F.coalesce("component", "bits")
        lowest = labelled.groupBy(label.alias("component")).agg(F.min("own_id").alias("component_id"))
        ids = labelled.select("bits", label.alias("component")).join(lowest, "component").select("bits", "component_id")
        result = every.join(ids, "bits", "left").select(
            "doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"),
            F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
        )
        return written(result, "simhash")
