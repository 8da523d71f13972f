"""Words and word shingles of whole texts, as arrays over the bytes of many texts.

All functions work on UTF-8 bytes. Lower-casing is that of A-Z alone, so that the
bytes of other characters never change and a byte class equals a character class.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = _U64(0xD6E8FEB86659FD93)

#: Bytes of texts that are worked on at once.
SLICE_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32

_codes = np.arange(256)
#: Words are what stands between white space: [^\x20\x09-\x0D]+
SPACED = ~((_codes == 0x20) | ((_codes >= 0x09) & (_codes <= 0x0D)))
#: Words of letters and digits: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
LETTERED = (
    ((_codes >= 0x30) & (_codes <= 0x39)) | ((_codes >= 0x61) & (_codes <= 0x7A)) | (_codes >= 0x80)
)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    values = values ^ (values >> _U64(30))
    values = values * _U64(0xBF58476D1CE4E5B9)
    values ^= values >> _U64(27)
    values *= _U64(0x94D049BB133111EB)
    values ^= values >> _U64(31)
    return values


_BYTE_VALUES = mix(np.arange(1, 257, dtype=_U64) * _U64(_BASE))
_powers: dict[str, np.ndarray] = {}


def _power(of: int, name: str, count: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < count:
        have = np.full(max(count, SLICE_BYTES + (1 << 16)), of, _U64)
        have[0] = 1
        have = np.cumprod(have, dtype=_U64)
        if len(have) <= 4 * SLICE_BYTES:
            _powers[name] = have
    return have[:count]


@dataclass
class Words:
    """Words of several texts, one after the other."""

    data: np.ndarray  # lower-cased bytes of the texts, a space after each
    starts: np.ndarray  # places in data
    ends: np.ndarray
    first: np.ndarray  # per text its first word's number, and at the end their count

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the words."""
        terms = _BYTE_VALUES[self.data]
        terms *= _power(_BASE, "up", len(terms))
        sums = np.zeros(len(terms) + 1, _U64)
        np.cumsum(terms, out=sums[1:])
        values = sums[self.ends] - sums[self.starts]
        values *= _power(_INVERSE, "down", len(terms))[self.starts]
        values += (self.ends - self.starts).astype(_U64) * _STEP
        return mix(values)

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(texts: Sequence[bytes], kind: np.ndarray, lower: bool = True) -> Words:
    buffer = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    data = _LOWER[buffer] if lower else buffer
    inside = kind[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edges = np.concatenate([[0], edges])
    starts, ends = edges[::2], edges[1::2]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.concatenate([[0], np.cumsum(lengths + 1)])
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of n words, across texts too."""
    count = max(len(hashes) - n + 1, 0)
    value = np.full(count, n, _U64)
    for k in range(n):
        value *= _STEP
        value += hashes[k: k + count]
    return mix(value)


@dataclass
class Shingles:
    """Hashes of the word shingles of several texts, sorted and distinct within each."""

    values: np.ndarray
    first: np.ndarray

    def of(self, text: int) -> np.ndarray:
        return self.values[self.first[text]: self.first[text + 1]]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def shingle_sets(texts: Sequence[bytes], n: int, kind: np.ndarray = SPACED) -> Shingles:
    """Per text its distinct n-word shingles; a text of fewer words has one, of all its words."""
    found = words(texts, kind)
    hashes, counts = found.hashes(), found.counts
    runs = ngram_hashes(hashes, n)
    sets = []
    for text, count in enumerate(counts):
        start = found.first[text]
        if count >= n:
            values = np.sort(runs[start: start + count - n + 1])
            keep = np.empty(len(values), bool)
            keep[0] = True
            np.not_equal(values[1:], values[:-1], out=keep[1:])
            sets.append(values[keep])
        elif count:
            sets.append(ngram_hashes(hashes[start: start + count], int(count)))
        else:
            sets.append(hashes[:0])
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)])
    return Shingles(np.concatenate(sets) if sets else hashes[:0], first)


def raw_texts(column: pa.Array) -> list[bytes]:
    """Texts as bytes; a null is empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def slices(texts: Sequence[bytes], limit: int = SLICE_BYTES, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many bytes, and of at most so many texts; at least one text each."""
    start, size = 0, 0
    for place, text in enumerate(texts):
        if (size and size + len(text) > limit) or place - start == most:
            yield start, place
            start, size = place, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def long_lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """Lists of 64-bit values."""
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values.view(np.int64)))
