"""Alignments of tokens against brute force over byte ranges, and edge cases."""

import hashlib
import os
from collections import Counter

import duckdb
import numpy as np
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from tickloom.llm import alignment
from tickloom.llm.queries import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def both():
    first = tokenizers.Tokenizer.from_file(f"{alignment.FOLDER}/{alignment.FIRST}")
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=f"{alignment.FOLDER}/{alignment.SECOND}")
    level = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    letters = {level.pre_tokenize_str(chr(c))[0][0]: bytes([c]) for c in range(128)}
    for c in range(128, 0x800):  # both bytes of two-byte characters
        for letter, byte in zip(level.pre_tokenize_str(chr(c))[0][0], chr(c).encode()):
            letters[letter] = bytes([byte])
    for c in (*range(0x1000, 0xD800, 0x1000), 0xF000, *range(0x10000, 0x110000, 0x1000)):
        for letter, byte in zip(level.pre_tokenize_str(chr(c))[0][0], chr(c).encode()):
            letters[letter] = bytes([byte])
    return first, second, letters


def spans(text, both):
    """(ids, byte ranges) of both tokenizers over the whole text, or nothing."""
    first, second, letters = both
    if not text:
        return None
    out = []
    ids = first.encode(" " + text, add_special_tokens=False).ids
    out.append((ids, [b"".join(letters[c] for c in first.id_to_token(i)) for i in ids]))
    ids = second.encode(text)
    piece = lambda i: bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(
        i).replace("▁", " ").encode()
    out.append((ids, [piece(i) for i in ids]))
    if any(b"".join(parts) != (" " + text).encode() for _, parts in out):
        return None
    return [(ids, np.cumsum([0, *map(len, parts)]).tolist()) for ids, parts in out]


def brute(rows, both):
    found, docs = [], Counter()
    for i, text in rows:
        if (laid := spans(text, both)) is None:
            found.append((i, 0, 0, 0, [], ""))
            continue
        (a, ends_a), (b, ends_b) = laid
        links, start = [], 0
        for m in range(len(a)):
            while ends_b[start + 1] <= ends_a[m]:
                start += 1
            n = start
            while n < len(b) and ends_b[n] < ends_a[m + 1]:
                links.append((a[m], b[n]))
                n += 1
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, at, to = [], 0, 0
        for cut in cuts[1:]:
            up, over = ends_a.index(cut, at), ends_b.index(cut, to)
            groups.append(",".join(map(str, a[at:up])) + "|" + ",".join(map(str, b[to:over])))
            at, to = up, over
        docs.update(set(links))
        found.append((i, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = Counter()
    for (a, _), n in docs.items():
        best[a] = max(best[a], n)
    return Counter(
        (i, n_a, n_b, n_groups, len(links), sum(docs[p] == best[p[0]] for p in links), sum(docs[p] for p in links), digest)
        for i, n_a, n_b, n_groups, links, digest in found
    )


def found(frame):
    return Counter(tuple(r) for r in frame.collect())


def test_whole_query(spark, both):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall()
    assert found(all_queries()["op13_alignment"](spark, SF_DIR)) == brute(rows, both)


def test_edges(spark, both):
    prose = " ".join(f"word{n % 91} Other{n % 37}, thing-{n}" for n in range(12_000))
    rows = [
        (1, None), (2, ""), (3, " "), (4, "  two  spaces "), (5, "a"), (5, "a"), (6, "<|endoftext|> <s> </s> <unk>"),
        (7, "a marker ▁ in it"), (8, "▁"), (9, "x" * 30_000), (10, prose), (11, "日本語 ñandú 🎉\x00\t\r\n."),
        (None, "without an id"), (12, "\n\n a b 　c"), (13, "é ﬁ ①"), (14, "0 1 2 " * 30_000),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("pairs", "pair", "times", "n", "n_a", "row_number", "docs", "best"):
        docs = docs.withColumn(name, F.lit("mine"))
    expected = brute(rows, both)
    for frequent in (alignment.FREQUENT, 500, 0):  # all pairs, some, none of them broadcast
        assert found(alignment.alignments(docs, frequent=frequent)) == expected
    assert alignment.alignments(docs.where("false")).count() == 0
