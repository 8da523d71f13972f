"""Tokens of two tokenizers laid side by side over the same bytes.

Both tokenizers spell a space and the text; their tokens are ranges of these bytes. Two
pointers, one a tokenizer, walk along each text: whichever token ends first is left behind,
and where both end at once there is a cut. All texts of a slice are walked in lockstep: one
array holds all first pointers, another all second ones, every step links the tokens the
pointers stand on, moves them, and drops the texts that are done. A long text is walked on
from several of its cuts at the same time, so that it does not keep a slice waiting.

Neither tokenizer has a token across a space between a visible ASCII character and a letter or
digit. What lies between such spaces is encoded once for all places where it recurs.

A pair of ids counts in how many documents it is linked. Links are kept per document as
different pairs with how often each occurs. Pairs follow the frequencies of words: the most
frequent, a bounded number, are looked up in a broadcast table, and the others, of which
a document holds few, in a join.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.frames import tidy
from tickloom.llm.store import Scratch, written
from tickloom.llm.text import raw_texts, slices

FOLDER = "/opt/tokenizers"
FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
MARKER = "▁"
#: Bytes of texts that are encoded and walked at once.
SLICE = 1 << 20
#: Bytes of units whose tokens are remembered; beyond them a task starts anew.
KEPT = 4 << 20
#: First-tokenizer tokens that a pointer walks along, about.
LANE = 128
#: Pairs that are looked up in a broadcast table, at most: some 20 MB.
FREQUENT = 1 << 19

#: The first one's words end before such a space; the second one's pieces hold spaces only at their start.
_SEAM = re.compile(rb"(?<=[!-~]) (?=[0-9A-Za-z])")
#: Units that may stand next to each other with a space between.
_PLAIN = re.compile(rb"[0-9A-Za-z](?:[^\x00]*[!-~])?", re.DOTALL)
_TOGETHER = 256


@dataclass(frozen=True)
class Tokenizers:
    """The files of both tokenizers; read by the driver, opened by each task."""

    first: bytes
    second: bytes


def tokenizers(folder: str = FOLDER, first: str = FIRST, second: str = SECOND) -> Tokenizers:
    """``first`` is a byte-level BPE of the tokenizers library, ``second`` a SentencePiece model."""
    parts = []
    for name in (first, second):
        with open(f"{folder}/{name}", "rb") as file:
            parts.append(file.read())
    return Tokenizers(*parts)


class _Opened:
    """Both tokenizers, and the bytes of their tokens by id."""

    def __init__(self, files: Tokenizers) -> None:
        # Tasks share the machine's cores already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_buffer(files.first)
        self.first.encode_special_tokens = True
        self.second = SentencePieceProcessor(model_proto=files.second)
        named = self.first.get_vocab(with_added_tokens=True)
        letters = _byte_letters()
        self.first_bytes = [b""] * (max(named.values()) + 1)
        for token, number in named.items():
            spelled = [letters.get(c) for c in token]
            self.first_bytes[number] = token.encode() if None in spelled else bytes(spelled)
        self.second_bytes = [
            bytes([int(piece[3:5], 16)]) if self.second.is_byte(n) else piece.replace(MARKER, " ").encode()
            for n in range(self.second.get_piece_size()) if (piece := self.second.id_to_piece(n)) is not None
        ]

    def first_ids(self, units: Sequence[str]) -> list[list[int]]:
        """Ids of a space and each unit."""
        return [e.ids for e in self.first.encode_batch_fast([f" {u}" for u in units], add_special_tokens=False)]

    def second_ids(self, units: Sequence[str]) -> list[list[int]]:
        """The same; this tokenizer adds the space itself."""
        return self.second.encode(list(units), num_threads=1)


@lru_cache(maxsize=1)
def _opened(files: Tokenizers) -> _Opened:
    return _Opened(files)


def _byte_letters() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary.

    Visible Latin-1 characters stand for themselves, the other bytes for characters from 256 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(hidden)}


@dataclass
class Tokens:
    """Ids of several texts by one tokenizer, one text after the other."""

    ids: np.ndarray
    ends: np.ndarray  # bytes of all texts up to each token's end
    first: np.ndarray  # per text its first token's number, and at the end their count


class _Lists:
    """Lists of ids of the units, by number, and whether they spell the unit."""

    def __init__(self, table: list[bytes], encode: Callable[[Sequence[str]], list[list[int]]]) -> None:
        self._table, self._encode = table, encode
        self._lengths = np.fromiter(map(len, table), np.int64, len(table))
        self.clear()

    def clear(self) -> None:
        self.ids, self.counts, self.good = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, units: Sequence[bytes]) -> None:
        """Units that tokens cannot cross the ends of are encoded many at a time."""
        plain = np.fromiter((_PLAIN.fullmatch(u) is not None for u in units), bool, len(units))
        ids, counts = np.zeros(0, np.int32), np.zeros(len(units), np.int64)
        together = [u for u, p in zip(units, plain.tolist(), strict=True) if p]
        if (found := self._together(together)) is None:
            plain[:], together, found = False, [], (ids, counts[:0])
        alone = [u for u, p in zip(units, plain.tolist(), strict=True) if not p]
        texts = [u.decode("utf-8", "replace") for u in alone]
        lists = self._encode(texts) if texts else []
        good = np.ones(len(units), bool)
        good[~plain] = [self._spelled(part) == b" " + unit for part, unit in zip(lists, alone, strict=True)]
        # In the order of the units, though encoded in two goes.
        number = np.argsort(np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)]))
        sizes = np.concatenate([found[1], np.fromiter(map(len, lists), np.int64, len(lists))])
        starts = (np.cumsum(sizes) - sizes)[number]
        counts = sizes[number]
        pool = np.concatenate([found[0], np.fromiter(chain.from_iterable(lists), np.int32)])
        self.ids = np.concatenate([self.ids, pool[_ranges(starts, counts)]])
        self.counts = np.concatenate([self.counts, counts])
        self.good = np.concatenate([self.good, good])

    def _spelled(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self._table.__getitem__, ids))

    def _together(self, units: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """All ids of the units and how many each has; nothing if they do not spell the units."""
        joined = [b" ".join(units[k: k + _TOGETHER]) for k in range(0, len(units), _TOGETHER)]
        texts = [j.decode("utf-8", "replace") for j in joined]
        flat = list(chain.from_iterable(self._encode(texts))) if texts else []
        if self._spelled(flat) != b"".join(b" " + j for j in joined):
            return None
        ids = np.array(flat, np.int32)
        ends = np.cumsum(self._lengths[ids])
        tails = np.cumsum(np.fromiter(map(len, units), np.int64, len(units)) + 1)
        upto = np.searchsorted(ends, tails, side="right")
        if len(tails) and (ends[upto - 1] != tails).any():
            return None
        return ids, np.diff(upto, prepend=0)

    def tokens(self, numbers: np.ndarray, first: np.ndarray) -> Tokens:
        """Of texts that are made of the numbered units."""
        counts = self.counts[numbers]
        ends = np.cumsum(counts)
        starts = (np.cumsum(self.counts) - self.counts)[numbers]
        ids = self.ids[_ranges(starts, counts)].astype(np.int64)
        return Tokens(ids, np.cumsum(self._lengths[ids]), np.concatenate([[0], ends])[first])


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, so many each."""
    return np.arange(counts.sum()) + np.repeat(starts - np.cumsum(counts) + counts, counts)


class Encoder:
    """Tokens of texts; remembers the units it has met, up to ``KEPT`` bytes of them and a slice."""

    def __init__(self, opened: _Opened) -> None:
        self._known: dict[bytes, int] = {}
        self._bytes = 0
        self._sides = (
            _Lists(opened.first_bytes, opened.first_ids), _Lists(opened.second_bytes, opened.second_ids)
        )

    def tokens(self, texts: Sequence[bytes]) -> tuple[Tokens, Tokens]:
        """Both tokenizers' tokens; a text that one of them does not spell exactly has none."""
        if self._bytes > KEPT:
            self._known.clear()
            self._bytes = 0
            for side in self._sides:
                side.clear()
        units = [_SEAM.split(text) if text else [] for text in texts]
        known = self._known
        before = len(known)
        flat = [known.setdefault(unit, len(known)) for part in units for unit in part]
        if len(known) > before:
            new = list(islice(reversed(known), len(known) - before))[::-1]
            self._bytes += sum(map(len, new))
            for side in self._sides:
                side.add(new)
        numbers = np.array(flat, np.int64)
        counts = np.fromiter(map(len, units), np.int64, len(units))
        owner = np.repeat(np.arange(len(units)), counts)
        bad = np.zeros(len(units), bool)
        bad[owner[~(self._sides[0].good & self._sides[1].good)[numbers]]] = True
        numbers, counts = numbers[~bad[owner]], np.where(bad, 0, counts)
        first = np.concatenate([[0], np.cumsum(counts)])
        return self._sides[0].tokens(numbers, first), self._sides[1].tokens(numbers, first)


def _lanes(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where pointers start, and where the first of each stops: at texts' starts, and on the way at cuts."""
    starts = a.first[:-1][np.diff(a.first) > 0]
    # Of a few tokens after each length of a lane, the first that ends where one of the others does.
    tried = (np.arange(LANE, len(a.ids), LANE)[:, None] + np.arange(16)).clip(max=len(a.ids) - 1)
    near = np.searchsorted(b.ends, a.ends[tried]).clip(max=max(len(b.ends) - 1, 0))
    common = b.ends[near] == a.ends[tried]
    some = common.any(axis=1)
    more = tried[some, common[some].argmax(axis=1)] + 1
    starts = np.union1d(starts, more[more < len(a.ids)]).astype(np.int64)
    before = np.where(starts > 0, a.ends[starts - 1], 0)
    return starts, np.searchsorted(b.ends, before, side="right"), np.append(starts[1:], len(a.ids))


def walked(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links as numbers of tokens (first, second), and the tokens of both at cuts, in order."""
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    if len(a.ids):
        at, other, stop = _lanes(a, b)
        while len(at):
            links_a.append(at)
            links_b.append(other)
            end, other_end = a.ends[at], b.ends[other]
            cut = end == other_end
            cuts_a.append(at[cut])
            cuts_b.append(other[cut])
            at, other = at + (end <= other_end), other + (other_end <= end)
            going = at < stop
            if not going.all():
                at, other, stop = at[going], other[going], stop[going]
    joined = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return joined(links_a), joined(links_b), np.sort(joined(cuts_a)), np.sort(joined(cuts_b))


def _groups_before(cuts: np.ndarray, count: int) -> np.ndarray:
    """The group of each token: how many cuts lie before it."""
    marks = np.zeros(count + 1, np.int64)
    marks[cuts + 1] = 1
    return np.cumsum(marks[:count])


@lru_cache(maxsize=1)
def _decimals(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers below count in decimal, with a place for a mark, and which characters count."""
    width = len(str(count))
    numbers = np.arange(count)[:, None] // 10 ** np.arange(width - 1, -1, -1)
    used = numbers > 0
    used[:, -1] = True
    blank = np.zeros((count, 1), np.uint8)
    return np.concatenate([(numbers % 10 + ord("0")).astype(np.uint8), blank], axis=1), np.concatenate([used, blank == 0], axis=1)


def spelled_groups(a: Tokens, b: Tokens, cuts_a: np.ndarray, cuts_b: np.ndarray, ids_below: int) -> list[bytes]:
    """Per text its groups as ``a1,a2|b1;a3|b2,b3``, ids in decimal."""
    n_a, n_b = len(a.ids), len(b.ids)
    in_a, in_b = _groups_before(cuts_a, n_a), _groups_before(cuts_b, n_b)
    # Before a token of the second kind stand all of the first up to its group's end, and so on.
    place_a = np.arange(n_a) + np.concatenate([[0], cuts_b + 1])[in_a]
    place_b = np.arange(n_b) + (cuts_a + 1)[in_b] if n_b else np.zeros(0, np.int64)
    ids, marks = np.zeros(n_a + n_b, np.int64), np.full(n_a + n_b, ord(","), np.uint8)
    ids[place_a], ids[place_b] = a.ids, b.ids
    marks[place_a[cuts_a]] = ord("|")
    marks[place_b[cuts_b]] = ord(";")
    decimals, used = _decimals(ids_below)
    chars, keep = decimals[ids], used[ids]
    chars[:, -1] = marks
    text = chars[keep].tobytes()
    sizes = np.concatenate([[0], np.cumsum(used.sum(axis=1)[ids])])
    bounds = sizes[a.first + b.first]
    # The mark after the last token of a text goes.
    return [text[low: max(low, high - 1)] for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


_ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " pairs array<long>, times array<int>"
)


def aligned(docs: DataFrame, files: Tokenizers, pair_base: int) -> DataFrame:
    """Per row its counts of tokens, groups and links, the digest of its groups, and its different
    id pairs, first id x ``pair_base`` + second id, with how many links each has."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = _opened(files)
        encoder = Encoder(opened)
        spread = pair_base * len(opened.first_bytes)
        ids_below = max(pair_base, len(opened.first_bytes))
        for batch in batches:
            texts = raw_texts(batch.column(1))
            for low, high in slices(texts, SLICE):
                count = high - low
                a, b = encoder.tokens(texts[low:high])
                links_a, links_b, cuts_a, cuts_b = walked(a, b)
                owner = np.repeat(np.arange(count), np.diff(a.first))
                # Texts of a slice, and both ids, fit into one number.
                linked = owner[links_a] * spread + a.ids[links_a] * pair_base + b.ids[links_b]
                different, times = np.unique(linked, return_counts=True)
                first = np.searchsorted(different, np.arange(count + 1) * spread)
                groups = spelled_groups(a, b, cuts_a, cuts_b, ids_below)
                digests = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
                offsets = pa.array(first, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, count), pa.array(np.diff(a.first)), pa.array(np.diff(b.first)),
                        pa.array(np.bincount(owner[cuts_a], minlength=count)),
                        pa.array(np.bincount(owner[links_a], minlength=count)), pa.array(digests, pa.string()),
                        pa.ListArray.from_arrays(offsets, pa.array(different % spread)),
                        pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
                    ],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidy(work), _ALIGNED)


def pair_counts(rows: DataFrame, pair_base: int) -> DataFrame:
    """(pair, docs, best): in how many rows each pair is, and whether its first id has none in more."""
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs"))
    first = F.expr(f"pair div {pair_base}")
    most = counts.groupBy(first.alias("first_id")).agg(F.max("docs").alias("most"))
    return counts.withColumn("first_id", first).join(most, "first_id").select(
        "pair", "docs", (F.col("docs") == F.col("most")).alias("best")
    )


def least_frequent(counts: DataFrame, limit: int) -> int:
    """The smallest power of two that at most so many pairs reach."""
    size = F.floor(F.log2("docs")).cast("int")
    octaves = {r.size: r.n for r in counts.groupBy(size.alias("size")).agg(F.count("*").alias("n")).collect()}
    power = max(octaves, default=-1) + 1
    total = 0
    while power > 0 and total + octaves.get(power - 1, 0) <= limit:
        power -= 1
        total += octaves.get(power, 0)
    return 1 << power


def alignments(docs: DataFrame, files: Tokenizers | None = None, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each row of docs (doc_id, text).

    ``n_best`` links have the highest count of their first id; ``count_sum`` adds the counts of
    all links. A text that is null or empty, or that a tokenizer does not spell byte for byte,
    has no tokens, zeros and an empty digest. Every row is a document, repeated ones and those
    without doc_id too. Other columns are not read. ``frequent`` is how many pairs may be
    broadcast.
    """
    files = files or tokenizers()
    pair_base = len(_opened(files).second_bytes)
    with Scratch(docs.sparkSession) as scratch:
        rows = scratch.write(
            aligned(docs, files, pair_base).withColumn("row_number", F.monotonically_increasing_id()), "aligned"
        )
        counts = scratch.write(pair_counts(rows, pair_base), "pair-counts")
        least = least_frequent(counts, frequent)
        held = rows.select("row_number", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("n"))))
        often, seldom = counts.where(F.col("docs") >= least), counts.where(F.col("docs") < least)
        met = held.join(F.broadcast(often), "pair")
        if least > 1:
            others = held.join(F.broadcast(often.select("pair")), "pair", "left_anti")
            met = met.unionByName(others.join(seldom.hint("merge"), "pair"))
        sums = met.groupBy("row_number").agg(
            F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).cast("long").alias("n_best"),
            F.sum(F.col("n") * F.col("docs")).alias("count_sum"),
        )
        none = F.lit(0).cast("long")
        result = rows.drop("pairs", "times").join(sums, "row_number", "left").select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"),
            F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256",
        )
        return written(result, "alignments")
