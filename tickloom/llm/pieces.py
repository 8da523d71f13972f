"""SentencePiece encoding and decoding with a unigram vocabulary.

Pieces lie in a double-array trie over bytes. A text is segmented into the pieces with the
largest sum of log scores (Viterbi); a character that no piece covers costs ten below the
least score and becomes one byte piece for each of its bytes. A text starts with a
whitespace marker of its own, which decoding takes off again, and every space is a marker.
Decoding the pieces of any text gives that text: a marker character that stands in the text
itself is spelled in bytes.

As pieces hold markers only at their start, segmentations of what lies between spaces do
not depend on each other: each different such unit of a slice is segmented once, and all
units together, place by place.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.frames import annotated

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
UNKNOWN_COST = 10.0
#: Longer units are segmented one by one.
LONG_UNIT = 200
#: A task remembers so many units at most, and starts anew beyond them.
KEPT_UNITS = 400_000


@dataclass
class Trie:
    """A double-array trie: from state s, byte c leads to base[s] + c if check says so."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray  # of a state, -1 if none ends there
    deepest: int


def double_array(words: dict[bytes, int]) -> Trie:
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for word, number in words.items():
        node = 0
        for byte in word:
            if byte not in children[node]:
                children[node][byte] = len(children)
                children.append({})
                ends.append(-1)
            node = children[node][byte]
        ends[node] = number
    size = 2 * len(children) + 512
    base, check, piece = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    check[0] = 0
    used = bytearray(size)
    used[0] = 1
    free = 1
    queue = [(0, 0)]
    for node, state in queue:
        piece[state] = ends[node]
        keys = sorted(children[node])
        if not keys:
            continue
        while used[free]:
            free += 1
        start = free
        while True:
            at = start - keys[0]
            if at >= 1 and not any(used[at + k] for k in keys):
                break
            start = used.find(0, start + 1)
        base[state] = at
        for key in keys:
            used[at + key] = 1
            check[at + key] = state
            queue.append((children[node][key], at + key))
        if at + 1024 > size:
            more = size
            base = np.concatenate([base, np.zeros(more, np.int32)])
            check, piece = (np.concatenate([x, np.full(more, -1, np.int32)]) for x in (check, piece))
            used.extend(bytes(more))
            size += more
    return Trie(base, check, piece, max(map(len, words), default=0))


@dataclass
class Vocabulary:
    """Spaces stand for markers in ``spellings``."""

    spellings: list[bytes]  # of each piece; empty for control pieces
    scores: np.ndarray
    byte_pieces: np.ndarray  # the piece of each byte
    trie: Trie
    units: re.Pattern

    def __post_init__(self) -> None:
        self.unknown = float(self.scores.min()) - UNKNOWN_COST
        self.spelled = np.frombuffer(b"".join(self.spellings), np.uint8)
        self.key = hash((tuple(self.spellings), self.scores.tobytes()))
        self.spelled_first = np.concatenate([[0], np.cumsum([len(s) for s in self.spellings])]).astype(np.int64)


def vocabulary(path: str = VOCABULARY) -> Vocabulary:
    """Read by the driver; tasks get the arrays."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    spellings: list[bytes] = []
    known: dict[bytes, int] = {}
    scores, byte_pieces = [], np.full(256, -1)
    for number in range(model.get_piece_size()):
        text, spelling, score = model.id_to_piece(number), b"", 0.0
        if model.is_byte(number):
            spelling = bytes([int(text[3:-1], 16)])
            byte_pieces[spelling[0]] = number
        elif not (model.is_control(number) or model.is_unknown(number) or model.is_unused(number)):
            spelling, score = text.replace(MARKER, " ").encode(), model.get_score(number)
            known[spelling] = number
        spellings.append(spelling)
        scores.append(score)
    if (byte_pieces < 0).any():
        raise ValueError("the vocabulary lacks byte pieces")
    return assembled(spellings, np.array(scores), byte_pieces, known)


def assembled(
    spellings: list[bytes], scores: np.ndarray, byte_pieces: np.ndarray, known: dict[bytes, int]
) -> Vocabulary:
    # No piece reaches over the edge of a unit.
    if any(b" " in k.lstrip(b" ") for k in known):
        units = re.compile(rb"(?s:.+)")
    elif any(b"\n" in k for k in known):
        units = re.compile(rb" *[^ ]+| +")
    else:
        units = re.compile(rb"\n| *[^ \n]+| +")
    return Vocabulary(spellings, scores, byte_pieces, double_array(known), units)


def _matches(data: np.ndarray, ends: np.ndarray, starts: np.ndarray, trie: Trie) -> tuple:
    """All pieces at the given places of data, none beyond the place's end: (start, length, piece)."""
    found: list[tuple] = []
    place, state = starts, np.zeros(len(starts), np.int64)
    for depth in range(trie.deepest):
        inside = place + depth < ends
        place, state, ends = place[inside], state[inside], ends[inside]
        if not len(place):
            break
        following = trie.base[state] + data[place + depth]
        goes_on = trie.check[following] == state
        # The root is its own parent; no byte leads to it.
        goes_on &= following > 0
        place, state, ends = place[goes_on], following[goes_on].astype(np.int64), ends[goes_on]
        piece = trie.piece[state]
        full = piece >= 0
        found.append((place[full], np.full(int(full.sum()), depth + 1), piece[full].astype(np.int64)))
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, (none, none, none), strict=True))


def segment(units: Sequence[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of all units, and where each unit's begin. Among equal sums the longer last piece wins."""
    none = np.zeros(0, np.int64)
    if not units:
        return none, np.zeros(1, np.int64)
    data = np.frombuffer(b"".join(units), np.uint8).astype(np.int64)
    lengths = np.fromiter(map(len, units), np.int64, len(units))
    first = np.concatenate([[0], np.cumsum(lengths)])
    unit = np.repeat(np.arange(len(units)), lengths)
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    begin, length, piece = _matches(data, first[unit[starts] + 1], starts, vocab.trie)
    # A character without a piece of its own.
    wide = np.diff(np.append(starts, len(data)))
    whole = np.zeros(len(data), bool)
    whole[begin[length == wide[np.searchsorted(starts, begin)]]] = True
    alone = starts[~whole[starts]]
    begin = np.concatenate([begin, alone])
    length = np.concatenate([length, wide[~whole[starts]]])
    scores = np.concatenate([vocab.scores[piece], np.full(len(alone), vocab.unknown)])
    piece = np.concatenate([piece, np.full(len(alone), -1)])

    end = begin + length
    best = np.full(len(data) + 1, -np.inf)
    best[first[:-1]] = 0.0
    # Places are shared by a unit's end and the next one's start: ends are kept apart.
    reached = np.full(len(data) + 1, -np.inf)
    back = np.full(len(data) + 1, -1)
    offset = end - first[unit[begin]]
    order = np.lexsort((begin, end, offset))
    begin, end, piece, scores, offset = (x[order] for x in (begin, end, piece, scores, offset))
    edges = np.flatnonzero(np.diff(offset, prepend=-1, append=-1))
    is_edge = np.zeros(len(data) + 1, bool)
    is_edge[first] = True
    numbers = np.arange(len(begin))
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        to = end[low:high]
        sums = best[begin[low:high]] + scores[low:high]
        np.maximum.at(reached, to, sums)
        wins = sums == reached[to]
        # From the last to the first: the smallest start, so the longest piece, stays.
        back[to[wins][::-1]] = numbers[low:high][wins][::-1]
        inner = to[~is_edge[to]]
        best[inner] = reached[inner]
    return _traced(first, begin, end, piece, back, data, vocab)


def _traced(first, begin, end, piece, back, data, vocab) -> tuple[np.ndarray, np.ndarray]:
    """Follow the best pieces from each unit's end to its start."""
    none = np.zeros(0, np.int64)
    picks, owners, steps = [none], [none], [none]
    at, owner = first[1:].copy(), np.arange(len(first) - 1)
    step = 0
    while len(at):
        pick = back[at]
        picks.append(pick)
        owners.append(owner)
        steps.append(np.full(len(pick), -step))
        at = begin[pick]
        open_ = at > first[owner]
        at, owner = at[open_], owner[open_]
        step += 1
    pick, owner, order = (np.concatenate(x) for x in (picks, owners, steps))
    order = np.lexsort((order, owner))
    pick, owner = pick[order], owner[order]
    number = piece[pick]
    spread = np.where(number < 0, end[pick] - begin[pick], 1)
    source = np.repeat(np.arange(len(pick)), spread)
    inside = np.arange(len(source)) - np.repeat(np.cumsum(spread) - spread, spread)
    out = np.where(
        number[source] < 0, vocab.byte_pieces[data[np.minimum(begin[pick][source] + inside, len(data) - 1)]],
        number[source],
    )
    counts = np.bincount(owner, weights=spread, minlength=len(first) - 1).astype(np.int64)
    return out, np.concatenate([[0], np.cumsum(counts)])


def _spans(first: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all members of the chosen lists, one after the other; and where each begins."""
    counts = first[chosen + 1] - first[chosen]
    starts = np.concatenate([[0], np.cumsum(counts)])
    return np.arange(starts[-1]) + np.repeat(first[chosen] - starts[:-1], counts), starts


class _Seen:
    """Units segmented so far by a task, to be used again by later slices."""

    def __init__(self) -> None:
        self.index: dict[bytes, int] = {}
        self.pieces = np.zeros(0, np.int32)
        self.first = np.zeros(1, np.int64)

    def learn(self, units: set[bytes], vocab: Vocabulary) -> None:
        # Long units would make every step of the common segmentation last long.
        short = [u for u in units if len(u) <= LONG_UNIT]
        self._add(short, *segment(short, vocab))
        for unit in units:
            if len(unit) > LONG_UNIT:
                self._add([unit], *segment([unit], vocab))

    def _add(self, units: list[bytes], pieces: np.ndarray, first: np.ndarray) -> None:
        known = len(self.index)
        self.index.update(zip(units, range(known, known + len(units)), strict=True))
        self.pieces = np.concatenate([self.pieces, pieces.astype(np.int32)])
        self.first = np.concatenate([self.first, self.first[-1] + first[1:]])


_seen: dict[int, _Seen] = {}


def encode(texts: Sequence[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of all texts, and where each text's begin. An empty text has none."""
    seen = _seen.setdefault(vocab.key, _Seen())
    units: list[bytes] = []
    first = [0]
    for text in texts:
        if text:
            units += vocab.units.findall(b" " + text)
        first.append(len(units))
    new = set(units).difference(seen.index)
    if len(seen.index) + len(new) > KEPT_UNITS:
        seen = _seen[vocab.key] = _Seen()
        new = set(units)
    seen.learn(new, vocab)
    chosen = np.fromiter(map(seen.index.__getitem__, units), np.int64, len(units))
    places, spread = _spans(seen.first, chosen)
    return seen.pieces[places], spread[np.array(first)]


def decode_bytes(pieces: np.ndarray, first: np.ndarray, vocab: Vocabulary) -> list[bytes]:
    """The texts that pieces spell, without their leading marker; control pieces spell nothing."""
    places, spread = _spans(vocab.spelled_first, pieces)
    spelled = vocab.spelled[places].tobytes()
    edges = spread[first].tolist()
    return [
        spelled[a + (spelled[a: a + 1] == b" "): b] if b > a else b"" for a, b in zip(edges, edges[1:], strict=False)
    ]


def encoded(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Each row of docs as ``row`` with tokens, n_tokens, n_bytes and exact.

    ``tokens`` are the piece numbers of the whole text, none for a null or empty one;
    ``n_bytes`` counts byte pieces; ``exact`` tells that decoding gave the text again.
    """
    is_byte = np.zeros(len(vocab.spellings), bool)
    is_byte[vocab.byte_pieces] = True

    def done() -> None:
        _seen.clear()

    def compute(texts: Sequence[bytes]) -> list[pa.Array]:
        pieces, first = encode(texts, vocab)
        again = decode_bytes(pieces, first, vocab)
        sums = np.concatenate([[0], np.cumsum(is_byte[pieces])])
        return [
            pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(pieces, pa.int32())),
            pa.array(np.diff(first), pa.int64()),
            pa.array(sums[first[1:]] - sums[first[:-1]], pa.int64()),
            pa.array([a == t for a, t in zip(again, texts, strict=True)]),
        ]

    return annotated(docs, "tokens array<int>, n_tokens long, n_bytes long, exact boolean", compute, done=done)


def decoded(frame: DataFrame, vocab: Vocabulary, column: str = "tokens") -> DataFrame:
    """The frame's columns and ``decoded``, the text of its piece numbers.

    A null list is a null text; bytes that are no UTF-8 become U+FFFD; numbers outside the
    vocabulary fail. A column of that name is replaced.
    """
    size = len(vocab.spellings)

    def work(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for lists in series:
            kept = [np.asarray(x if x is not None else [], np.int64) for x in lists]
            if any(len(x) and (x.min() < 0 or x.max() >= size) for x in kept):
                raise ValueError("a piece number is outside the vocabulary")
            first = np.concatenate([[0], np.cumsum([len(x) for x in kept])]).astype(np.int64)
            texts = decode_bytes(np.concatenate(kept) if kept else np.zeros(0, np.int64), first, vocab)
            yield pd.Series(
                [None if x is None else t.decode("utf-8", "replace") for x, t in zip(lists, texts, strict=True)],
                dtype=object,
            )

    return frame.withColumn("decoded", F.pandas_udf(work, "string")(column))
