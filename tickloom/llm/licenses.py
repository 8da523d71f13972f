"""License scans by conditional compression.

Candidate blocks are the stretches of a text in which enough words of a template crowd
together; outside of them no template can be stated within the differences that are allowed,
so nothing else has to be looked at. A block is hardly longer than a template. It is
compressed with every template in turn as a raw Zstandard dictionary, and the templates are
ranked by the bytes that saves. In that order they are confirmed by their exact wording
differences, the smallest number of words to add, drop or change that turns the template into
some stretch of the block; the first that is near enough is the block's license. What is
confirmed is cut out, and the rest is scanned again, so that a block may state several.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.frames import tidy

# The usual wordings of license notices.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "BSD": (
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
        "to this work.",
    ),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction',
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}
# Stems of words, as patterns that mark lines on licenses.
STEMS = ("licen", "copyright", "permission", "permitted", "redistribut", r"public[\W_]+domain")

#: Lines without such a stem between two with one still belong to the run.
GAP = 2
#: Of a template's words so many hundredths may differ.
DIFFERENT_PERCENT = 20
#: Blocks of more words than this and the longest template are cut into overlapping ones.
PIECE = 40
#: Words between licenses that are cut out together, and words around a block that belong to
#: its region: more than any template may match.
APART = 60
#: Savings that differ by no more bytes than these are equal: headers and entropy tables vary as much.
SAME_BYTES = 4
LEVEL = 19

_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
_STEM = re.compile("|".join(STEMS))


@dataclass(frozen=True)
class Template:
    license_id: str
    number: int
    text: str
    words: tuple[str, ...]

    @property
    def spare(self) -> int:
        """So many words may differ."""
        return DIFFERENT_PERCENT * len(self.words) // 100


def spelled(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


@lru_cache(maxsize=1)
def templates() -> list[Template]:
    return [
        Template(name, number, text, tuple(spelled(text)))
        for name, texts in TEMPLATES.items() for number, text in enumerate(texts)
    ]


@lru_cache(maxsize=1)
def _compressors() -> tuple[zstandard.ZstdCompressor, dict[Template, zstandard.ZstdCompressor]]:
    make = lambda **more: zstandard.ZstdCompressor(
        level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, **more
    )
    return make(), {
        t: make(dict_data=zstandard.ZstdCompressionDict(t.text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))
        for t in templates()
    }


def saved_bytes(text: str, template: Template) -> int:
    """How many bytes less a text takes when compressed with the template as dictionary."""
    raw = text.encode()
    plain, conditional = _compressors()
    return len(plain.compress(raw)) - len(conditional[template].compress(raw))


def closest(wanted: tuple[str, ...], words: list[str]) -> tuple[int, int, int, list[str]]:
    """The stretch of words that differs least from the wanted ones: (differences, start, stop, what differs).

    Differences are words added, dropped or changed, the fewest possible; among equal
    stretches the first one that ends, and the shortest.
    """
    count = len(words)
    numbers = {w: n for n, w in enumerate(wanted)}
    codes = np.fromiter((numbers.get(w, -1) for w in words), np.int32, count)
    table = np.zeros((len(wanted) + 1, count + 1), np.int32)
    along = np.arange(count + 1)
    for row, word in enumerate(wanted, 1):
        best = table[row - 1] + 1
        np.minimum(best[1:], table[row - 1, :-1] + (codes != numbers[word]), out=best[1:])
        # A word of the block may be passed over, again and again: a running minimum along the row.
        table[row] = np.minimum.accumulate(best - along) + along
    stop = place = int(np.argmin(table[-1]))
    row, notes = len(wanted), []
    while row:
        here = table[row, place]
        if place and here == table[row - 1, place - 1] + (wanted[row - 1] != words[place - 1]):
            row, place = row - 1, place - 1
            if wanted[row] != words[place]:
                notes.append(f"{wanted[row]} > {words[place]}")
        elif here == table[row - 1, place] + 1:
            row -= 1
            notes.append(f"- {wanted[row]}")
        else:
            place -= 1
            notes.append(f"+ {words[place]}")
    return int(table[-1, stop]), place, stop, notes[::-1]


@lru_cache(maxsize=1)
def _vocabulary() -> tuple[dict[str, int], np.ndarray]:
    """Numbers of all templates' words, and which template (rows) has which (columns, one more for none)."""
    known = templates()
    numbers = {w: n for n, w in enumerate(sorted({w for t in known for w in t.words}))}
    has = np.zeros((len(known), len(numbers) + 1), bool)
    for row, template in enumerate(known):
        has[row, [numbers[w] for w in template.words]] = True
    return numbers, has


def crowded(words: Sequence[str]) -> dict[tuple[int, int], list[Template]]:
    """Blocks (start, stop) of words outside of which no template is stated, in order, each with the
    templates that may be.

    A run that differs in so many words as may be has all but as many of the template's words,
    within as many more words than the template's.
    """
    numbers, has = _vocabulary()
    get, none = numbers.get, len(numbers)
    codes = np.fromiter((get(w, none) for w in words), np.int64, len(words))
    ranges = []
    for row, template in enumerate(templates()):
        sums = np.concatenate([[0], np.cumsum(has[row, codes])])
        reach = min(len(template.words) + template.spare, len(words))
        starts = np.flatnonzero(sums[reach:] - sums[:-reach] >= len(template.words) - template.spare)
        if len(starts):
            heads = np.concatenate([[True], np.diff(starts) > reach])
            tails = np.append(heads[1:], True)
            ranges += [(a, b + reach, template) for a, b in zip(starts[heads].tolist(), starts[tails].tolist(), strict=True)]
    blocks: dict[tuple[int, int], list[Template]] = {}
    ranges.sort(key=lambda r: r[:2])
    while ranges:
        low, high, _ = ranges[0]
        count = 0
        while count < len(ranges) and ranges[count][0] < high:
            high = max(high, ranges[count][1])
            count += 1
        for start in range(low, max(high - APART, low + 1), PIECE):
            stop = min(start + PIECE + APART, high)
            blocks[start, stop] = [t for a, b, t in ranges[:count] if a < stop and b > start]
        del ranges[:count]
    return blocks


def ranked(text: str) -> list[tuple[int, Template]]:
    """(bytes saved, template) of all templates as dictionary of the text, those that save most first."""
    return sorted(((saved_bytes(text, t), t) for t in templates()), key=lambda r: (-r[0], r[1].license_id, r[1].number))


def stated_in(words: list[str], spans: list[str], able: list[Template]) -> tuple | None:
    """(bytes saved, template, differences, start, stop, what differs) of the license that a block states.

    Of templates that save about as many bytes as the first that is confirmed, the one of fewest
    differences is taken, ties to the one that saves more. Templates that the block has too few
    words of are not able to be confirmed.
    """
    best, level = None, None
    for saved, template in ranked(_plain(spans)):
        if best and saved < level - SAME_BYTES:
            break
        if template in able:
            different, start, stop, notes = closest(template.words, words)
            if different <= template.spare and (best is None or different < best[2]):
                best = saved, template, different, start, stop, notes
                level = saved if level is None else level
    return best


def _plain(spans: Sequence[str]) -> str:
    return " ".join("".join(spans).split())


def licenses_of(spans: list[str]) -> list[tuple[int, int, tuple]]:
    """(first word, last word, (license_id, saved_bytes, n_words, n_different, differences)) of each license
    that words state; a span is a word and what stands up to the next one.

    Each block states one license at a time. Those that save most are cut out first, with what
    is far from them, and the rest is searched again. ``saved_bytes`` is for the words that match.
    """
    words = [_WORD.match(s).group().lower() for s in spans]
    place = list(range(len(words)))
    found = []
    while words:
        near = []
        for (low, high), able in crowded(words).items():
            inside = [spans[p] for p in place[low:high]]
            if block := stated_in(words[low:high], inside, able):
                saved, template, different, start, stop, notes = block
                row = (
                    template.license_id, saved_bytes(_plain(inside[start:stop]), template), len(template.words),
                    different, tuple(notes),
                )
                near.append((-saved, different, low + start, low + stop, row))
        taken = []
        # What stands around a cut is decided after it.
        later = np.zeros(len(words), bool)
        for _, _, start, stop, row in sorted(near):
            if not later[start:stop].any():
                taken.append((start, stop))
                found.append((place[start], place[stop - 1], row))
                later[max(start - APART, 0): stop + APART] = True
        if not taken:
            break
        for start, stop in sorted(taken, reverse=True):
            del words[start:stop], place[start:stop]
    return found


def regions(words: Sequence[str]) -> Iterator[tuple[int, int]]:
    """(start, stop) of words that blocks and what stands around them are in; no two overlap."""
    open_: tuple[int, int] | None = None
    for start, stop in crowded(words):
        start, stop = max(start - APART, 0), min(stop + APART, len(words))
        if open_ and start <= open_[1]:
            open_ = open_[0], max(open_[1], stop)
            continue
        if open_:
            yield open_
        open_ = start, stop
    if open_:
        yield open_


def marked_lines(text: str) -> list[tuple[int, int]]:
    """(first, last) of the stretches of lines with a stem."""
    found: list[tuple[int, int]] = []
    lower, line, done = text.lower(), 0, 0
    for stem in _STEM.finditer(lower):
        first = line + lower.count("\n", done, stem.start())
        line, done = first + stem.group().count("\n"), stem.end()
        if found and first - found[-1][1] <= GAP + 1:
            found[-1] = (found[-1][0], line)
        else:
            found.append((first, line))
    return found


def stated(text: str) -> Iterator[tuple]:
    """(first line, lines, license_id, ...) of each license: the lines of its words, and of the run of marked
    lines that these stand in."""
    around = list(regions([w.lower() for w in _WORD.findall(text)]))
    if not around:
        return
    places = [w.start() for w in _WORD.finditer(text)]
    breaks = [b.start() for b in re.finditer("\n", text)]
    ends, marked = [*places[1:], len(text)], marked_lines(text)
    for low, high in around:
        spans = [text[a:b] for a, b in zip(places[low:high], ends[low:high], strict=True)]
        for start, stop, found in licenses_of(spans):
            first, last = (bisect_left(breaks, places[low + p]) for p in (start, stop))
            near = [m for m in marked if m[0] <= last and m[1] >= first]
            first, last = min([first, *(m[0] for m in near)]), max([last, *(m[1] for m in near)])
            yield first, last - first + 1, *found


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, first_line, n_lines, license_id, saved_bytes, n_words, n_different, differences).

    One row per license that a text of docs (doc_id, text) states; lines count from 0 and are those
    of its words and of the run of lines with a stem (``STEMS``) that it stands in. Stems decide nothing
    else: every word of every text is looked at.
    ``n_words`` is the length of the template, ``differences`` says ``a > b`` for a changed
    word, ``- a`` for a missing and ``+ b`` for an added one. Texts that are null, empty or
    state no license have no row; repeated rows are scanned each, null ids too.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            rows = [(place, *found) for place in range(len(texts)) for found in stated(texts[place].as_py())]
            if rows:
                place, *values = zip(*rows, strict=True)
                kinds = (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(place)), *map(pa.array, map(list, values), kinds)],
                    names=["doc_id", "first_line", "n_lines", "license_id", "saved_bytes", "n_words", "n_different",
                           "differences"],
                )

    kept = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where(
        "text IS NOT NULL"
    )
    return kept.mapInArrow(
        tidy(work), "doc_id long, first_line int, n_lines int, license_id string, saved_bytes int, n_words int, "
        "n_different int, differences array<string>",
    )
