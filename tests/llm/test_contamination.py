"""Decontamination against brute force over every window and every pair of places."""

import hashlib
import random
import tracemalloc

import pytest

from tickloom.llm import contamination as module


def brute(text, items):
    """Hit words, items and the longest match of a list of words."""
    hit, names, best = set(), set(), (0, None, None, None)
    for name, item in items:
        size = min(module.WINDOW, len(item))
        for k in range(len(item) - size + 1 if size else 0):
            for place in range(len(text) - size + 1):
                if text[place: place + size] == item[k: k + size]:
                    hit.update(range(place, place + size))
                    names.add(name)
        for place in range(len(text)):
            for k in range(len(item)):
                n = 0
                while place + n < len(text) and k + n < len(item) and text[place + n] == item[k + n]:
                    n += 1
                if n and (n > best[0] or (n == best[0] and place < best[1])):
                    best = (n, place, name, k)
    digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    return (len(text), len(hit), len(names), digest, bool(hit), *best)


def made(seed, count, longest, known):
    draw = random.Random(seed)
    return [draw.choices(known, k=draw.randrange(longest)) for _ in range(count)]


@pytest.mark.parametrize("sizes", [1, 2, 6])
@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_short_and_long_items(spark, sizes, block_bytes):
    known = [f"w{n}" for n in range(sizes)]
    items = sorted({(f"i{n % 7}", tuple(x)) for n, x in enumerate(made(sizes, 12, 24, known))})
    items = [(name, list(x)) for name, x in items]
    texts = dict(enumerate(made(sizes + 100, 25, 40, [*known, "other"])))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    table = spark.createDataFrame([(n, " ".join(t)) for n, t in items], "item_id string, text string")
    # Ids that count once are located by the smallest text.
    items = sorted(items, key=lambda x: (x[0], " ".join(x[1])))
    found = module.contamination(docs, table, block_bytes=block_bytes)
    rows = {r.row.doc_id: tuple(r)[1:] for r in found.collect()}
    expected = {i: brute(t, items) for i, t in texts.items()}
    if block_bytes > 1000:
        assert rows == expected
    else:  # one id may be in several blocks, so the place in the item is not compared
        assert {i: r[:8] for i, r in rows.items()} == {i: r[:8] for i, r in expected.items()}


def test_equal_short_items_cost_one_suffix():
    """10,000 answers reading yes, and a text that says nothing else."""
    tracemalloc.start()
    suffix = module.suffixes([str(n) for n in range(10_000)], [b"yes"] * 10_000)
    text, _ = module.shard([b"yes " * 20_000, b"no"], suffix)
    found = module.search(text, suffix)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.hit[:20_000].all() and found.texts.tolist() == [0] and len(suffix.items_of(found.windows)) == 10_000
    assert peak < 200 << 20


def test_matches_below_a_window_are_located(spark):
    docs = spark.createDataFrame([(1, "x a b c d y"), (2, None), (3, "")], "doc_id long, text string")
    items = spark.createDataFrame(
        [(5, " ".join([*"pq", *"abcd", *(f"w{n}" for n in range(9))]))], "item_id long, text string"
    )
    rows = {r.row.doc_id: tuple(r)[5:] for r in module.contamination(docs, items).collect()}
    assert rows == {1: (False, 4, 1, "5", 2), 2: (False, 0, None, None, None), 3: (False, 0, None, None, None)}
    assert [tuple(r) for r in module.longest_matches(docs, items, least=3).collect()] == [(1, 1, "5", 2, 4)]
