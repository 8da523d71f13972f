"""Benchmark decontamination with suffix arrays over the training texts.

Training texts are worked on in shards, slices of a partition. A shard's suffix array
orders the places in it by the words that follow; every suffix of every benchmark item is
searched in it by bisection, word by word, which gives the longest verbatim match at each
place, whatever its length, and on the way the places of each window. Nothing is shuffled.

Suffixes that begin with the same words are bisected together, and windows of equal words are
one window, so a range of the array is read once for each depth, however many items share it.
Places of words that are in no item are left out of the arrays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.llm.frames import rows_of, tidy
from tickloom.llm.text import LETTERED, raw_texts, slices, words

WINDOW = 10
#: Benchmark text that is sent to the tasks at once; more is searched in several passes.
BLOCK_BYTES = 16 << 20


@dataclass
class Suffixes:
    """The suffixes of benchmark items, as numbers of words that occur in them."""

    names: list[str]
    vocabulary: np.ndarray  # sorted hashes; word k + 1 is the k-th
    tokens: np.ndarray  # words of all items, a 0 after each item
    first: np.ndarray  # each item's first place in tokens
    order: np.ndarray  # the suffixes' places in tokens, sorted by the words that follow
    lengths: np.ndarray  # of the sorted suffixes: words of the window that begins it; 0 where none does
    numbers: np.ndarray  # of the sorted suffixes: its window, numbered by the words; -1 where none begins
    items: np.ndarray  # items with window 0, with window 1, ...
    bounds: np.ndarray  # each window's first entry in items

    def items_of(self, windows: np.ndarray) -> set[str]:
        """Names of all items that hold one of the windows."""
        return {self.names[i] for w in windows.tolist() for i in self.items[self.bounds[w]: self.bounds[w + 1]].tolist()}

    def item_words(self, suffix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items of places in tokens, and the words before them in the item."""
        item = np.searchsorted(self.first, suffix, "right") - 1
        return item, suffix - self.first[item]


def suffixes(names: Sequence[str], texts: Sequence[bytes], window: int = WINDOW) -> Suffixes:
    found = words(texts, LETTERED)
    vocabulary, numbered = np.unique(found.hashes(), return_inverse=True)
    owners = found.owners()
    tokens = np.zeros(len(numbered) + len(texts), np.int64)
    tokens[np.arange(len(numbered)) + owners] = numbered + 1
    first = found.first + np.arange(len(texts) + 1)
    order = _ordered(tokens, np.flatnonzero(tokens), len(vocabulary))
    item = np.searchsorted(first, order, "right") - 1
    left = first[item + 1] - 1 - order
    lengths = np.where(left >= window, window, np.where(left == found.counts[item], left, 0))
    begins = np.flatnonzero(lengths)
    places = order[begins]
    same, ended = np.ones(max(len(begins) - 1, 0), bool), np.zeros(max(len(begins) - 1, 0), bool)
    for k in range(window):  # equal to the window before, up to where both end
        word = tokens[np.minimum(places + k, len(tokens) - 1)]
        same &= ended | (word[1:] == word[:-1])
        ended |= same & (word[1:] == 0)
    numbers = np.full(len(order), -1)
    numbers[begins] = np.concatenate([[0], np.cumsum(~same)])[: len(begins)]
    count = int(numbers.max(initial=-1)) + 1
    pairs = np.unique(numbers[begins] * max(1, len(texts)) + item[begins])
    bounds = np.searchsorted(pairs, np.arange(count + 1) * max(1, len(texts)))
    return Suffixes(list(names), vocabulary, tokens, first, order, lengths, numbers, pairs % max(1, len(texts)), bounds)


@dataclass
class Shard:
    """Training texts as numbers of benchmark words (0: none of them), and their suffix array."""

    tokens: np.ndarray  # a 0 after each text
    first: np.ndarray  # each text's first place in tokens
    array: np.ndarray


def _ordered(tokens: np.ndarray, places: np.ndarray, largest: int) -> np.ndarray:
    """Places of all words by the tokens that follow, up to a 0, by sorting on twice as many each time."""
    bits = int(largest + 1).bit_length()
    done = max(1, 63 // bits)
    padded = np.concatenate([tokens, np.zeros(done, np.int64)])
    packed = np.zeros(len(tokens), np.int64)
    for k in range(done):
        packed = (packed << bits) | padded[k: k + len(tokens)]
    key = packed[places]
    order = np.argsort(key, kind="stable")
    places, key = places[order], key[order]
    tied = np.zeros(len(places) + 1, bool)  # equal to the place before
    tied[1:-1] = key[1:] == key[:-1]
    along = np.arange(1, len(places) + 1)
    rank = np.zeros(len(tokens) + 1, np.int64)  # of each place among all; 0 for what ends a text
    rank[places] = np.maximum.accumulate(np.where(tied[:-1], 0, along))
    while len(group := np.flatnonzero(tied[:-1] | tied[1:])) and done < len(tokens):
        members = places[group]
        label, key = rank[members], rank[np.minimum(members + done, len(tokens))]
        order = np.lexsort((key, label))
        members, key = members[order], key[order]
        places[group] = members
        same = np.zeros(len(group), bool)
        # A 0 ends both: nothing that follows orders them.
        same[1:] = (key[1:] == key[:-1]) & (key[1:] > 0)
        tied[group] &= same
        rank[members] = np.maximum.accumulate(np.where(tied[group], 0, along[group]))
        done *= 2
    return places


def shard(texts: Sequence[bytes], suffix: Suffixes) -> tuple[Shard, np.ndarray]:
    """The shard of the texts, and their counts of words."""
    found = words(texts, LETTERED)
    hashes, owners = found.hashes(), found.owners()
    size = len(suffix.vocabulary)
    number = np.zeros(len(hashes), np.int64)
    if size:
        near = np.minimum(np.searchsorted(suffix.vocabulary, hashes), size - 1)
        number = np.where(suffix.vocabulary[near] == hashes, near + 1, 0)
    tokens = np.zeros(len(hashes) + len(texts), np.int64)
    tokens[np.arange(len(hashes)) + owners] = number
    array = _ordered(tokens, np.flatnonzero(tokens), size)
    return Shard(tokens, found.first + np.arange(len(texts) + 1), array), found.counts


def _bound(text: Shard, low: np.ndarray, high: np.ndarray, depth: int, word: np.ndarray) -> np.ndarray:
    """First entry of each range of the array whose token at the depth is the word or larger."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) >> 1
        # A range that is settled reads some entry, and keeps its place.
        entry = text.array[np.minimum(middle, len(text.array) - 1)]
        seen = text.tokens[np.minimum(entry + depth, len(text.tokens) - 1)]
        less = open_ & (seen < word)
        low = np.where(less, middle + 1, low)
        high = np.where(open_ & ~less, middle, high)
    return low


def _expanded(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and for each the range it is from."""
    counts = high - low
    source = np.repeat(np.arange(len(low)), counts)
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + low[source], source


@dataclass
class Found:
    """What of the items is in a shard."""

    hit: np.ndarray  # per token whether a window's occurrence covers it
    texts: np.ndarray  # texts and windows that occur in them, sorted
    windows: np.ndarray
    length: np.ndarray  # per token the words of the longest match that begins there
    suffix: np.ndarray  # per token the first place in the items' tokens that matches so far

    def longest(self, text: Shard) -> tuple[np.ndarray, np.ndarray]:
        """Per text the length of its longest match, and the token where the first such begins."""
        heads = text.first[:-1]  # each text has its 0 at least
        length = np.maximum.reduceat(self.length, heads) if len(heads) else self.length[:0]
        ends = np.flatnonzero(self.length == np.repeat(length, np.diff(text.first)))
        return length, ends[np.searchsorted(ends, heads)] if len(heads) else heads


def search(text: Shard, suffix: Suffixes) -> Found:
    """Bisect all suffixes of the items, word by word; those that agree so far share a range of the array."""
    count = max(1, len(suffix.bounds) - 1)
    marks = np.zeros(len(text.tokens) + 1, np.int64)
    length, first = np.zeros(len(text.tokens), np.int64), np.zeros(len(text.tokens), np.int64)
    owner = np.searchsorted(text.first, text.array, "right") - 1
    pairs = [np.zeros(0, np.int64)]
    active = np.arange(len(suffix.order) if len(text.array) else 0)
    node = np.zeros(len(active), np.int64)
    low, high = np.zeros(1, np.int64), np.full(1, len(text.array))
    depth = 0
    while True:
        word = suffix.tokens[suffix.order[active] + depth]
        active, node, word = active[word > 0], node[word > 0], word[word > 0]
        if not len(active):
            break
        changes = np.ones(len(active), bool)
        changes[1:] = (node[1:] != node[:-1]) | (word[1:] != word[:-1])
        parent, next_word = node[changes], word[changes]
        new_low = _bound(text, low[parent], high[parent], depth, next_word)
        new_high = _bound(text, new_low, high[parent], depth, next_word + 1)
        some = new_low < new_high
        node = np.cumsum(changes) - 1
        goes_on = some[node]
        active, node = active[goes_on], (np.cumsum(some) - 1)[node[goes_on]]
        low, high = new_low[some], new_high[some]
        depth += 1
        if not len(active):
            break
        heads = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        entry, source = _expanded(low, high)
        places = text.array[entry]
        length[places] = depth
        first[places] = np.minimum.reduceat(suffix.order[active], heads)[source]
        begins = suffix.lengths[active] == depth
        window = np.full(len(low), -1)
        window[node[begins]] = suffix.numbers[active[begins]]
        window = window[source]
        inside = window >= 0
        marks += np.bincount(places[inside], minlength=len(marks))
        marks -= np.bincount(places[inside] + depth, minlength=len(marks))
        pairs.append(np.unique(owner[entry[inside]] * count + window[inside]))
    pair = np.unique(np.concatenate(pairs))
    return Found(np.cumsum(marks)[:-1] > 0, pair // count, pair % count, length, first)


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[list[str], list[bytes]]]:
    """The items in blocks of about so many bytes."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string")).where(
        "item IS NOT NULL AND text IS NOT NULL"
    )
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = max(1, -(-size // block_bytes))
    for block in range(count):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == block)
        rows = sorted({(r.item, r.text) for r in part.collect()})
        yield [r[0] for r in rows], [r[1].encode() for r in rows]


def _items_digest(items: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


_MATCH = "longest_match int, longest_word long, longest_item string, longest_item_word long"
_STATE = f"hits array<long>, items array<string>, {_MATCH}"
_RESULT = f"n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, {_MATCH}"


def contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each row of docs as ``row``, with what of its ``text`` is in the benchmark.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. A window
    is ``WINDOW`` consecutive words of an item, or all words of a shorter one. Columns:
    n_words; n_hit, words inside any window's occurrence; n_items, distinct items with an
    occurring window, and items_sha256 of their ids (sorted as texts, joined by commas);
    contaminated (n_hit > 0); longest_match, the most words in a row that agree with an item,
    also fewer than a window; longest_word, the words before the first such match in the text;
    longest_item, the smallest id of an item that has it, and longest_item_word, the words
    before it there (nulls where no word agrees). Texts that are null or without words have
    zeros; items without id, text or words take no part; equal item ids count once, of their
    texts that the smallest one locates a match; an empty benchmark leaves everything clean.
    """
    frame = docs.select(rows_of(docs))
    blocks = _blocks(benchmark, block_bytes)
    this = next(blocks)
    opened = False
    while this is not None:
        following = next(blocks, None)
        frame = _passed(frame, suffixes(*this), opened, following is None)
        opened, this = True, following
    return frame


def _passed(frame: DataFrame, suffix: Suffixes, opened: bool, last: bool) -> DataFrame:
    """One pass over the texts for a block; the last one counts what all passes hit."""
    fields = _RESULT if last else _STATE

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw_texts(pc.struct_field(batch.column(0), "text"))
            state = [c.to_pylist() for c in batch.columns[1:]] if opened else None
            for low, high in slices(texts):
                text, counts = shard(texts[low:high], suffix)
                found = search(text, suffix)
                hit, matches = found.hit, _located(text, suffix, found)
                # Sets of items, or their digests, of each different list of windows.
                known: dict[bytes, tuple] = {}
                bounds = np.searchsorted(found.texts, np.arange(high - low + 1))
                earlier = [x[low:high] for x in state] if state else None
                held = []
                for i in range(high - low):
                    windows = found.windows[bounds[i]: bounds[i + 1]]
                    more = earlier[1][i] if earlier else []
                    key = b"" if more else windows.tobytes()
                    if more or key not in known:
                        items = suffix.items_of(windows).union(more)
                        value = (len(items), _items_digest(items)) if last else (sorted(items),)
                        if more:
                            held.append(value)
                            continue
                        known[key] = value
                    held.append(known[key])
                if earlier:
                    for i, (places, _, *match) in enumerate(zip(*earlier, strict=True)):
                        hit[np.array(places, np.int64) + text.first[i]] = True
                        matches[i] = min(matches[i], tuple(match), key=_preferred)
                columns = list(map(pa.array, zip(*matches, strict=True), _MATCH_TYPES))
                if last:
                    sums = np.concatenate([[0], np.cumsum(hit)])
                    n_hit = sums[text.first[1:]] - sums[text.first[:-1]]
                    columns = [
                        pa.array(counts, pa.int64()), pa.array(n_hit, pa.int64()),
                        pa.array([n for n, _ in held], pa.int64()), pa.array([d for _, d in held], pa.string()),
                        pa.array(n_hit > 0), *columns,
                    ]
                else:
                    places = [np.flatnonzero(hit[a:b]) for a, b in zip(text.first, text.first[1:], strict=False)]
                    columns = [
                        pa.array([p.tolist() for p in places], pa.list_(pa.int64())),
                        pa.array([x for x, in held], pa.list_(pa.string())), *columns,
                    ]
                names = ["row", *(f.split()[0] for f in fields.split(", "))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), *columns], names=names)

    return frame.mapInArrow(tidy(work), StructType([frame.schema["row"], *StructType.fromDDL(fields).fields]))


_MATCH_TYPES = (pa.int32(), pa.int64(), pa.string(), pa.int64())


def _located(text: Shard, suffix: Suffixes, found: Found) -> list[tuple]:
    """Per text its longest match: length, word of the text, item and word of the item."""
    length, token = found.longest(text)
    item, before = suffix.item_words(found.suffix[token])
    rows = zip(length.tolist(), (token - text.first[:-1]).tolist(), item.tolist(), before.tolist(), strict=True)
    return [(n, place, suffix.names[i], k) if n else (0, None, None, None) for n, place, i, k in rows]


def _preferred(match: tuple) -> tuple:
    """Longer matches first, then earlier ones, then smaller items."""
    length, place, item, before = match
    return (-length, place, item, before) if length else (0,)


def longest_matches(
    docs: DataFrame, benchmark: DataFrame, least: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(doc_id, doc_word, item_id, item_word, n_words): every match of at least so many words that
    is not the rest of one beginning a word earlier, as long as it goes on in any item.

    A place of a text has one row for each block of the benchmark at most: its longest match, in
    the smallest item id that has it. Texts and items that are null or without words have none.
    """
    out = None
    for block in _blocks(benchmark, block_bytes):
        suffix = suffixes(*block)

        def work(batches: Iterator[pa.RecordBatch], suffix: Suffixes = suffix) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = raw_texts(batch.column(1))
                for low, high in slices(texts):
                    text, _ = shard(texts[low:high], suffix)
                    found = search(text, suffix)
                    rest = np.zeros(len(found.length), bool)
                    rest[1:] = found.length[1:] == found.length[:-1] - 1
                    token = np.flatnonzero((found.length >= max(least, 1)) & ~rest)
                    owner = np.searchsorted(text.first, token, "right") - 1
                    item, before = suffix.item_words(found.suffix[token])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(low, high - low).take(pa.array(owner)),
                            pa.array(token - text.first[owner], pa.int64()),
                            pa.array([suffix.names[i] for i in item.tolist()], pa.string()),
                            pa.array(before, pa.int64()),
                            pa.array(found.length[token], pa.int64()),
                        ],
                        names=["doc_id", "doc_word", "item_id", "item_word", "n_words"],
                    )

        fields = StructType.fromDDL("doc_word long, item_id string, item_word long, n_words long").fields
        part = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
            tidy(work), StructType([docs.schema["doc_id"], *fields])
        )
        out = part if out is None else out.unionByName(part)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs without a word of a benchmark window."""
    return contamination(docs, benchmark).where("NOT contaminated").select("row.*")
