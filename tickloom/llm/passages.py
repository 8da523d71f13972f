"""Passages that repeat across documents: MinHash of paragraphs, verified exactly.

Two kinds of paragraphs are compared. Copied passages rarely keep to line breaks, so every
run of ``WORDS`` words is a paragraph, and its MinHash is the least hash of its word
shingles: as a passage is copied word by word, one hash finds every copy. Paragraphs that
collide and belong to different documents are joined and verified by the digest of all
their words, together with the MinHash 128 bits; overlapping ones merge into passages.
Lines, and lines between blank ones taken together, of at least ``WORDS`` words are paragraphs
as well; these may be edited, so they go through bands of MinHash registers, tuned for recall,
and exact Jaccard similarity.

A text is cut into words once: the same pass signs its runs and sketches its units.

In each group of equal or linked paragraphs the first stays, by doc_id; the others are to be
removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from xxhash import xxh3_128_digest

from tickloom.llm.frames import rows_of, tidy
from tickloom.llm.near_dup import Banding, linked, registers
from tickloom.llm.store import Scratch, dropped, written
from tickloom.llm.text import SPACED, long_lists, mix, ngram_hashes, raw_texts, slices, words

WORDS = 50
SHINGLE = 5
#: What tells documents apart: two texts of one doc_id are two documents.
KEY = ["doc_id", "text_id"]
#: Lines and paragraphs of fewer words are not compared as units: short lines, headings and signatures,
#: recur in documents that have nothing else in common.
LEAST_WORDS = 50
#: Runs that are broadcast, fewer than; they hold more than this part of all rows, or so many rows.
HOT = 10_000
#: A pair of lines or paragraphs at the least similarity, 0.75, shares no band with a chance of 0.0005.
LINES = Banding(rows=4, bands=20)

_U64 = np.uint64


def _windowed(values: np.ndarray, width: int, best: np.ufunc, filler: int) -> np.ndarray:
    """The best of each run of values: of blocks' heads and tails, one of each covers any run."""
    count = len(values) - width + 1
    padded = np.concatenate([values, np.full(-len(values) % width, filler, values.dtype)]).reshape(-1, width)
    heads = best.accumulate(padded, axis=1).reshape(-1)
    tails = best.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return best(tails[:count], heads[width - 1: width - 1 + count])


def minima(shingles: np.ndarray, width: int) -> np.ndarray:
    """The least hash of each run of so many shingles."""
    return _windowed(shingles, width, np.minimum, int(np.iinfo(np.uint64).max))


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_id, text): rows of one doc_id and one text are a document."""
    return docs.select(
        F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")).alias("text_id"), F.col("text").cast("string")
    ).where("doc_id IS NOT NULL AND text IS NOT NULL")


@dataclass(frozen=True)
class _Text:
    """The words of one text of a slice."""

    number: int
    hashes: np.ndarray
    least: np.ndarray  # MinHash of each run of WORDS words
    shingles: np.ndarray
    lines: np.ndarray  # line breaks of the slice before each word


def _texts(texts: list[bytes]) -> Iterator[_Text]:
    """The texts of at least WORDS words."""
    found = words(texts, SPACED)
    hashes = found.hashes()
    shingles = ngram_hashes(hashes, SHINGLE)
    lines = np.searchsorted(np.flatnonzero(found.data == ord("\n")), found.starts)
    for text in np.flatnonzero(found.counts >= WORDS).tolist():
        start, stop = int(found.first[text]), int(found.first[text + 1])
        own = shingles[start: stop - SHINGLE + 1]
        yield _Text(text, hashes[start:stop], minima(own, WORDS - SHINGLE + 1), own, lines[start:stop])


def units_of(lines: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(place, words) of the lines, and of the paragraphs of several lines, that have so many words.

    ``lines`` counts the line breaks before each word; paragraphs are parted by two and more.
    """
    steps = np.diff(lines)
    cut = lambda breaks: np.concatenate([[0], np.flatnonzero(breaks) + 1, [len(lines)]])
    found = []
    for edges, several in ((cut(steps > 0), False), (cut(steps > 1), True)):
        sizes = np.diff(edges)
        for unit in np.flatnonzero(sizes >= least):
            place, count = int(edges[unit]), int(sizes[unit])
            # A paragraph of one line is that line.
            if not several or lines[place] != lines[place + count - 1]:
                found.append((place, count))
    return found


_SURVEY = (
    "doc_id long, text_id long, n_words int, digest binary, marks array<long>,"
    " units array<struct<place:int, n_words:int, n_shingles:long, set_id:binary, registers:binary>>"
)


def _survey(docs: DataFrame, least: int) -> DataFrame:
    """Per text of at least WORDS words a 128-bit digest of them, the different MinHashes of its runs,
    and of its lines and paragraphs place, size, a digest and HyperMinHash registers of their shingles."""
    unit_type = pa.struct([
        ("place", pa.int32()), ("n_words", pa.int32()), ("n_shingles", pa.int64()), ("set_id", pa.binary()),
        ("registers", pa.binary()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw_texts(batch.column(2))
            for low, high in slices(texts):
                source, counts, digests, marks, units, sets = [], [], [], [], [], []
                for text in _texts(texts[low:high]):
                    source.append(low + text.number)
                    counts.append(len(text.hashes))
                    digests.append(xxh3_128_digest(text.hashes.tobytes()))
                    marks.append(np.unique(text.least))
                    units.append(units_of(text.lines, least))
                    sets += [np.unique(text.shingles[p: p + max(n - SHINGLE + 1, 1)]) for p, n in units[-1]]
                if not source:
                    continue
                starts = np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)])
                rows = registers(np.concatenate([*sets, np.zeros(0, _U64)]), starts, LINES.buckets)
                flat = [u for part in units for u in part]
                unit_rows = pa.array([
                    (place, count, len(values), xxh3_128_digest(values.tobytes()), row.tobytes())
                    for (place, count), values, row in zip(flat, sets, rows, strict=True)
                ], unit_type)
                unit_first = np.concatenate([[0], np.cumsum([len(u) for u in units])])
                keys = pa.array(source)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(keys), batch.column(1).take(keys), pa.array(counts, pa.int32()),
                        pa.array(digests, pa.binary()),
                        long_lists(np.concatenate(marks), np.concatenate([[0], np.cumsum([len(m) for m in marks])])),
                        pa.ListArray.from_arrays(pa.array(unit_first, pa.int32()), unit_rows),
                    ],
                    names=["doc_id", "text_id", "n_words", "digest", "marks", "units"],
                )

    return docs.mapInArrow(tidy(work), _SURVEY)


def _runs(docs: DataFrame) -> DataFrame:
    """(text_no, place, mark, digest) of the runs of (text_no, text, marks) whose MinHash is among the marks."""
    factor = _U64(0x9FB21C651E98DF25)
    inverse = _U64(pow(int(factor), -1, 1 << 64))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw_texts(batch.column(1))
            for low, high in slices(texts):
                parts: list[list] = [[], [], [], []]
                for text in _texts(texts[low:high]):
                    wanted = np.array(batch.column(2)[low + text.number].as_py(), np.int64).view(_U64)
                    places = np.flatnonzero(np.isin(text.least, wanted))
                    # A polynomial of the words from a place on, by differences of running sums.
                    powers = np.cumprod(np.concatenate([[_U64(1)], np.full(len(text.hashes) - 1, factor)]))
                    sums = np.concatenate([[_U64(0)], np.cumsum(text.hashes * powers)])
                    scale = np.cumprod(np.concatenate([[_U64(1)], np.full(len(text.hashes) - 1, inverse)]))
                    digest = mix((sums[places + WORDS] - sums[places]) * scale[places])
                    for part, values in zip(
                        parts, (np.full(len(places), low + text.number), places, text.least[places], digest), strict=True
                    ):
                        part.append(values)
                if parts[0]:
                    source, place, mark, digest = (np.concatenate(p) for p in parts)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(source)), pa.array(place, pa.int32()),
                            pa.array(mark.view(np.int64)), pa.array(digest.view(np.int64)),
                        ],
                        names=["text_no", "place", "mark", "digest"],
                    )

    return docs.select("text_no", "text", "marks").mapInArrow(
        tidy(work), "text_no long, place int, mark long, digest long"
    )


def _firsts(rows: DataFrame, *keys: str) -> DataFrame:
    """Per key that several texts have, the first of them as ``source``, and the number of rows."""
    return rows.groupBy(*keys).agg(
        F.min("text_no").alias("source"), F.max("text_no").alias("last"), F.count("*").alias("n")
    ).where("source <> last").drop("last")


def _run_spans(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """(text_no, place, n_words, source) of runs that several texts hold, by their ``marks`` (doc_id,
    text_id, text_no, marks).

    Runs that hold a large part of all rows, a bounded number of them, are looked up in a broadcast
    table instead of meeting in one task.
    """
    with Scratch(docs.sparkSession) as scratch:
        each = marks.select(*KEY, "text_no", F.explode("marks").alias("mark"))
        wanted = each.join(_firsts(each, "mark").select("mark"), "mark").groupBy(*KEY, "text_no").agg(
            F.collect_set("mark").alias("marks")
        )
        runs = scratch.write(_runs(docs.join(scratch.write(wanted, "marks"), KEY)), "runs")
        sources = scratch.write(_firsts(runs, "mark", "digest"), "run-sources")
        # Fewer than HOT runs can hold that many of the rows.
        large = max(HOT, runs.count() // HOT)
        hot = sources.where(F.col("n") > large).drop("n")
        other = sources.where(F.col("n") <= large).drop("n")
        found, rest = [], runs
        if not hot.isEmpty():
            hot = F.broadcast(hot)
            found.append(runs.join(hot, ["mark", "digest"]))
            rest = runs.join(hot.select("mark", "digest"), ["mark", "digest"], "left_anti")
        found.append(rest.join(other, ["mark", "digest"]))
        found = reduce(DataFrame.unionByName, [part.select("text_no", "place", "source") for part in found])
        return written(_spans(found), "copied-runs")


def _spans(found: DataFrame) -> DataFrame:
    """Runs of a text with the same source, one word apart each, as longer ones."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in _pieces(batch.column(1)):
                part = batch.slice(low, high - low)
                places = part.column(1)
                owner = np.repeat(np.arange(part.num_rows), pc.list_value_length(places).to_numpy())
                place = pc.struct_field(places.flatten(), "place").to_numpy().astype(np.int64)
                source = pc.struct_field(places.flatten(), "source").to_numpy()
                order = np.lexsort((place, source, owner))
                owner, place, source = owner[order], place[order], source[order]
                new = (np.diff(owner) != 0) | (np.diff(source) != 0) | (np.diff(place) > 1)
                heads = np.flatnonzero(np.concatenate([[True], new]))
                tails = np.append(heads[1:], len(owner)) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(owner[heads])), pa.array(place[heads], pa.int32()),
                        pa.array(place[tails] - place[heads] + WORDS, pa.int32()), pa.array(source[heads]),
                    ],
                    names=["text_no", "place", "n_words", "source"],
                )

    # What one document holds is bound by its length.
    held = found.groupBy("text_no").agg(F.collect_list(F.struct("place", "source")).alias("places"))
    return held.mapInArrow(tidy(work), "text_no long, place int, n_words int, source long")


def _pieces(lists: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of lists of about so many members."""
    start, size = 0, 0
    for place, count in enumerate(pc.list_value_length(lists).to_pylist()):
        if size and size + count > limit:
            yield start, place
            start, size = place, 0
        size += count
    if start < len(lists):
        yield start, len(lists)


def _unit_sets(docs: DataFrame) -> DataFrame:
    """(id, shingles): the sorted distinct shingles of the ``units`` (id, place, n_words) of texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw_texts(batch.column(0))
            for low, high in slices(texts):
                ids, sets = [], []
                for text in _texts(texts[low:high]):
                    for unit in batch.column(1)[low + text.number].as_py():
                        ids.append(unit["id"])
                        stop = unit["place"] + max(unit["n_words"] - SHINGLE + 1, 1)
                        sets.append(np.unique(text.shingles[unit["place"]: stop]))
                if ids:
                    first = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), long_lists(np.concatenate(sets), first)], names=["id", "shingles"]
                    )

    return docs.select("text", "units").mapInArrow(tidy(work), "id long, shingles array<long>")


def _unit_spans(docs: DataFrame, units: DataFrame, classes: DataFrame) -> DataFrame:
    """(text_no, place, n_words, source) of lines and paragraphs that are alike in several texts.

    ``units`` says where they are (doc_id, text_id, text_no, place, n_words, set_id), ``classes``
    holds each different set once (set_id, id, n_shingles, registers).
    """
    with Scratch(docs.sparkSession) as scratch:
        named = classes.select("set_id", "id")

        def sets_of(wanted: DataFrame) -> DataFrame:
            # One place of each set.
            place = F.min(F.struct(*KEY, "place", "n_words")).alias("at")
            placed = units.join(named.join(wanted, "id"), "set_id").groupBy("id").agg(place)
            chosen = placed.groupBy(F.col("at.doc_id"), F.col("at.text_id")).agg(
                F.collect_list(F.struct("id", "at.place", "at.n_words")).alias("units")
            )
            # The same join at every size: texts are never joined with a broadcast of ids. A document that
            # stands in several rows gives its sets once; the join has brought these rows together.
            return _unit_sets(docs.join(chosen.hint("merge"), KEY).dropDuplicates(KEY))

        found = scratch.adopt(linked(classes.select("id", "n_shingles", "registers"), sets_of, LINES))
        labels = named.join(found, "id", "left").select("set_id", F.coalesce("component", "id").alias("component"))
        grouped = scratch.write(
            units.select("text_no", "place", "n_words", "set_id").join(labels, "set_id").drop("set_id"), "grouped-units"
        )
        out = grouped.join(_firsts(grouped, "component").drop("n"), "component")
        return written(out.select("text_no", "place", "n_words", "source"), "alike-units")


def passages(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, text_id, place, n_words, component_id, kept): passages of docs (doc_id, text) that other documents hold.

    ``place`` is the number of words before the passage, words being runs without white
    space. ``component_id`` is the doc_id of the first document with the passage, or the
    smallest of them where it is made of passages of several; ``kept`` is true in the
    document in which the passage stays. A document without repeats has no row. Rows of one
    doc_id and one text are one document, rows of one doc_id and different texts are several,
    told apart by ``text_id``, xxhash64 of the text. Rows without doc_id or text take no part.
    Texts of fewer than ``WORDS`` words hold no passage; lines and paragraphs of fewer than
    ``least_words`` words are compared only as parts of runs.
    """
    keyed = _keyed(docs)
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        survey = written(_survey(keyed, least_words), "survey")
        # Documents of equal words are one from the start: only the first of them is searched, and
        # the others are copies of it as a whole.
        own = F.struct(*KEY)
        classes = scratch.write(
            survey.groupBy("digest").agg(F.min(own).alias("first"), F.max(own).alias("last")), "text-classes"
        )
        # Numbers in the order of documents: sorted ranges, counted up from range to range.
        numbers = scratch.write(
            classes.select("first.*").orderBy(*KEY).withColumn("text_no", F.monotonically_increasing_id()), "text-numbers"
        )
        copied = classes.where("first <> last").select("digest", F.col("first.doc_id").alias("source_id"), "first")
        whole = survey.join(copied, "digest").select(
            *KEY, F.lit(0).alias("place"), "n_words", "source_id", (F.col("first") == own).alias("kept")
        )
        whole = scratch.write(whole.distinct(), "whole-copies")
        # One row of each number, and so of each key: the join has brought these together.
        first = survey.join(numbers.hint("merge"), KEY).dropDuplicates(KEY)
        marks = scratch.write(first.select(*KEY, "text_no", "marks"), "text-marks")
        units = scratch.write(
            first.select(*KEY, "text_no", F.inline("units")).select(*KEY, "text_no", "place", "n_words", "set_id"), "units"
        )
        # Numbered where they are written: no two sets share an id.
        sets = survey.select(F.inline("units")).groupBy("set_id").agg(
            F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers")
        )
        unit_classes = scratch.write(sets.withColumn("id", F.monotonically_increasing_id()), "unit-classes")
        dropped(spark, survey._written_at)

        spans = scratch.adopt(_run_spans(keyed, marks)).unionByName(
            scratch.adopt(_unit_spans(keyed, units, unit_classes))
        )
        sources = numbers.select(F.col("text_no").alias("source"), F.col("doc_id").alias("source_id"))
        parts = spans.join(numbers, "text_no").join(sources, "source").select(
            *KEY, "place", "n_words", "source_id", (F.col("source") == F.col("text_no")).alias("kept")
        )
        # What one document holds is bound by its length.
        held = whole.unionByName(parts).groupBy(*KEY, "kept").agg(
            F.collect_list(F.struct("place", "n_words", "source_id")).alias("spans")
        )
        found = held.mapInArrow(
            _merged, "doc_id long, text_id long, kept boolean, place int, n_words int, component_id long"
        )
        return written(found.select(*KEY, "place", "n_words", "component_id", "kept"), "passages")


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of a document that overlap or touch become one, with their smallest source."""
    for batch in batches:
        spans = batch.column(3)
        if not len(spans.flatten()):
            continue
        owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(spans).to_numpy())
        place, count, source = (
            pc.struct_field(spans.flatten(), n).to_numpy().astype(np.int64) for n in ("place", "n_words", "source_id")
        )
        order = np.lexsort((place, owner))
        owner, place, count, source = (x[order] for x in (owner, place, count, source))
        # Places of different documents are kept apart, so that one running maximum serves all.
        apart = owner * (1 << 33)
        reach = np.maximum.accumulate(apart + place + count)
        heads = np.flatnonzero(np.concatenate([[True], (apart + place)[1:] > reach[:-1]]))
        tails = np.append(heads[1:], len(owner)) - 1
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(c).take(pa.array(owner[heads])) for c in range(3)],
                pa.array(place[heads], pa.int32()),
                pa.array((reach[tails] - apart[heads] - place[heads]), pa.int32()),
                pa.array(np.minimum.reduceat(source, heads), pa.int64()),
            ],
            names=["doc_id", "text_id", "kept", "place", "n_words", "component_id"],
        )


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of docs with their repeated passages cut out; all columns stay, n_chars is counted anew.

    A document of which no word is left goes. Where nothing is cut, the text stays as it is;
    where something is, what stands around it is joined by a line break.
    """
    cuts = (
        passages(docs).where("NOT kept").groupBy(F.col("doc_id").alias("cut_id"), F.col("text_id").alias("cut_text_id"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "n_words"))).alias("cuts"))
    )
    # By document and text: what was found in one text is never cut out of another.
    same = (F.col("row.doc_id") == F.col("cut_id")) & (F.xxhash64("row.text") == F.col("cut_text_id"))
    frame = docs.select(rows_of(docs)).join(cuts, same & F.col("row.text").isNotNull(), "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw_texts(pc.struct_field(batch.column(0), "text"))
            cut = batch.column(1).to_pylist()
            left: list[bytes | None] = [None] * len(texts)
            chosen = [n for n, c in enumerate(cut) if c]
            for low, high in slices([texts[n] for n in chosen]):
                numbers = chosen[low:high]
                found = words([texts[n] for n in numbers], SPACED)
                offset = 0
                for text, n in enumerate(numbers):
                    left[n] = _cut(texts[n], found, text, offset, cut[n])
                    offset += len(texts[n]) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(left, pa.binary()).cast(pa.string())], names=["row", "left"]
            )

    fields = StructType([frame.schema["row"], *StructType.fromDDL("left string").fields])
    done = frame.select("row", "cuts").mapInArrow(tidy(work), fields).where("left IS NULL OR left <> ''")
    changed = {"text": F.coalesce("left", "row.text")}
    if "n_chars" in docs.columns:
        size = F.char_length("left").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("left").isNull(), F.col("row.n_chars")).otherwise(size)
    return done.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def _cut(raw: bytes, found: Words, text: int, offset: int, cuts: list[dict]) -> bytes:
    """What stands around the cuts of a text that begins at the offset in the words' bytes."""
    first, parts, done = int(found.first[text]), [], 0
    for cut in cuts:
        start = int(found.starts[first + cut["place"]]) - offset
        parts.append(raw[done:start].strip())
        done = int(found.ends[first + cut["place"] + cut["n_words"] - 1]) - offset
    parts.append(raw[done:].strip())
    return b"\n".join(p for p in parts if p)
