"""The registered queries against SQL, brute force, round trips and held-out labels."""

import hashlib
import os
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest

import compare
import corpus_pipeline
from tickloom.llm import near_dup, pieces, warc
from tickloom.llm.queries import all_queries, all_sql

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
_SPACED, _LETTERED = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans({chr(65 + n): chr(97 + n) for n in range(26)})


def rows_of(name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{SF_DIR}/{name}.parquet'").fetchall()


@pytest.fixture(scope="module")
def docs():
    return dict(rows_of("documents", "doc_id, text"))


def run(spark, name):
    return all_queries()[name](spark, SF_DIR).collect()


def test_each_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in all_queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_query_equals_sql(spark, name):
    assert compare.difference(all_queries()[name](spark, SF_DIR), compare.connect(SF_DIR), all_sql()[name]) is None


def shingles(text):
    words = _SPACED.findall((text or "").translate(_LOWER))
    return {tuple(words[k: k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def components(docs):
    sets, parent = {i: shingles(t) for i, t in docs.items()}, {i: i for i in docs}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(docs)
    for place, a in enumerate(ids):
        for b in ids[place + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((top(a), top(b)))
                parent[high] = low
    return {i: (len(sets[i]), top(i)) for i in ids}


def test_near_duplicates(spark, docs):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in run(spark, "op6_near_duplicates")}
    assert found == components(docs)


def edited(count):
    """A text and copies with a few words changed, some too far from each other to link."""
    base = [f"word{n}" for n in range(100)]
    out = {}
    for copy in range(count):
        words = list(base)
        for k in range(copy % 4):
            words[(copy * 7 + k * 31) % 100] = f"new{copy}x{k}"
        out[copy] = " ".join(words)
    return out


def test_near_duplicates_of_one_large_group(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    texts = edited(150)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(frame).collect()}
    assert found == components(texts)


def test_registers_estimate_similarity():
    random = np.random.default_rng(1)
    values = random.integers(0, 1 << 63, 3000, dtype=np.uint64) << np.uint64(1)
    for size, shared in ((1000, 0.8), (20, 0.8), (1000, 0.0)):
        common = int(2 * size * shared / (1 + shared))
        a, b = np.sort(values[:size]), np.sort(values[size - common: 2 * size - common])
        rows = [near_dup.registers(x, np.array([0, size]), 4000) for x in (a, b)]
        got = near_dup.estimates(rows[0], rows[1], np.array([size]), np.array([size]))[0]
        true = common / (2 * size - common)
        assert abs(got - true) < 0.1


def brute_passages(docs):
    """(every, removed): words of repeated passages by document, and of those that a document before holds."""
    words = {i: [w.decode() for w in (t or "").encode().lower().split()] for i, t in docs.items()}
    every, removed = defaultdict(set), defaultdict(set)

    def add(spans, source):
        for i, place, count in spans:
            every[i].update(range(place, place + count))
            if i != source:
                removed[i].update(range(place, place + count))

    runs = defaultdict(list)
    for i in words:
        for place in range(len(words[i]) - 49):
            runs[tuple(words[i][place: place + 50])].append((i, place, 50))
    for spans in runs.values():
        if len({i for i, _, _ in spans}) > 1:
            add(spans, min(spans)[0])
    units = []
    for i, text in docs.items():
        for pattern, several in ((r"\n", False), (r"\n[ \t\r\f\v]*\n[\s]*", True)):
            place = 0
            for part in re.split(pattern, text or ""):
                own = _SPACED.findall(part.translate(_LOWER))
                lines = [line for line in part.split("\n") if _SPACED.search(line)]
                if len(own) >= 50 and (not several or len(lines) > 1):
                    units.append((i, place, len(own), {tuple(own[k: k + 5]) for k in range(len(own) - 4)}))
                place += len(own)
    top = list(range(len(units)))

    def find(n):
        while top[n] != n:
            n = top[n]
        return n

    for m in range(len(units)):
        for n in range(m):
            common = len(units[m][3] & units[n][3])
            if 100 * common >= 75 * (len(units[m][3]) + len(units[n][3]) - common):
                top[find(m)] = find(n)
    groups = defaultdict(list)
    for n, unit in enumerate(units):
        groups[find(n)].append(unit[:3])
    for spans in groups.values():
        if len({i for i, _, _ in spans}) > 1:
            add(spans, min(spans)[0])
    return dict(every), {i: places for i, places in removed.items() if places}


def spans_of(found):
    every, removed = defaultdict(set), defaultdict(set)
    for r in found:
        every[r.doc_id].update(range(r.place, r.place + r.n_words))
        if not r.kept:
            removed[r.doc_id].update(range(r.place, r.place + r.n_words))
    return dict(every), dict(removed)


def test_passages(spark, docs):
    """Runs, lines and paragraphs against all pairs."""
    assert spans_of(run(spark, "op2_passages")) == brute_passages(docs)


def test_edited_lines_and_paragraphs_are_passages(spark):
    from tickloom.llm import passages

    line = " ".join(f"word{n}" for n in range(80))
    edited = line.replace("word40", "new")
    wrapped = "\n".join(" ".join(f"p{n}" for n in range(12 * k, 12 * k + 12)) for k in range(20))
    other = re.sub(r"\bp(20|62|104|146|188|230)\b", "q", wrapped)
    texts = [
        f"a b c\n\n{line}\n\nd", f"x\n\n{edited}", "no repeat at all", f"start\n\n{wrapped}\n\nend",
        f"another start\n \n{other}\n\t\n", " ".join(f"z{n}" for n in range(60)),
    ]
    frame = spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")
    found = passages.passages(frame)
    rows = sorted((r.doc_id, r.place, r.n_words, r.component_id, r.kept) for r in found.collect())
    assert rows == [(1, 3, 80, 1, True), (2, 1, 80, 1, False), (4, 1, 240, 4, True), (5, 2, 240, 4, False)]
    assert spans_of(found.collect()) == brute_passages(dict(enumerate(texts, 1)))
    left = {r.doc_id: r.text for r in passages.without_repeats(frame).collect()}
    assert left == {**dict(enumerate(texts, 1)), 2: "x", 5: "another start"}


def test_rows_of_one_id_with_different_texts(spark):
    """A row's cuts are made in its own text, and one copy of every passage stays."""
    from tickloom.llm import passages

    first, second = (" ".join(f"{c}{n}" for n in range(200)) for c in "ac")
    cases = [
        ([(1, first), (2, first), (2, "x y z")], [(1, first), (2, "x y z")]),
        # A line that is alike goes as a whole.
        ([(1, first), (2, first), (2, second), (3, f"{second} end")], [(1, first), (2, second)]),
        ([(1, first), (1, first), (1, f"{first} more")], [(1, first), (1, first)]),
    ]
    for rows, expected in cases:
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        left = sorted((r.doc_id, r.text) for r in passages.without_repeats(frame).collect())
        # Of two texts with one doc_id either may come first.
        alternatives = [sorted(expected)]
        if rows[-1][0] == 1:
            alternatives.append(sorted([(1, f"{first} more")]))
        assert left in alternatives


def test_hot_runs_are_looked_up(spark, monkeypatch):
    from tickloom.llm import passages

    shared = " ".join(f"s{n}" for n in range(70))
    texts = {n: f"own{n} {shared} tail{n} " + " ".join(f"o{n}x{k}" for k in range(60)) for n in range(30)}
    texts |= {n: texts[n - 100].replace("own", "other") for n in range(100, 110)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    expected = brute_passages(texts)
    for hot in (1, 20, 10_000):
        monkeypatch.setattr(passages, "HOT", hot)
        assert spans_of(passages.passages(frame).collect()) == expected


def test_decontamination(spark, docs):
    windows = defaultdict(set)
    for item, text in rows_of("benchmark", "item_id, text"):
        words = _LETTERED.findall((text or "").translate(_LOWER))
        for k in range(max(1, len(words) - 9) if words else 0):
            windows[tuple(words[k: k + 10])].add(str(item))
    expected = {}
    for i, text in docs.items():
        words = _LETTERED.findall((text or "").translate(_LOWER))
        hit, items = set(), set()
        for k in range(len(words)):
            if (found := windows.get(tuple(words[k: k + 10]))) and (k + 10 <= len(words)):
                items |= found
                hit.update(range(k, k + 10))
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        expected[i] = (len(words), len(hit), len(items), digest, bool(hit))
    found = {r.doc_id: tuple(r)[1:6] for r in run(spark, "op4_decontamination")}
    assert found == expected


def test_contamination_in_blocks(spark):
    from tickloom.llm import contamination

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    whole = contamination.contamination(docs, items).drop("row").collect()
    parts = contamination.contamination(docs, items, block_bytes=2000).drop("row").collect()
    assert whole == parts


def test_longest_matches(spark):
    from tickloom.llm import contamination

    docs = spark.createDataFrame(
        [(1, "x y " + " ".join(f"w{n}" for n in range(12)) + " z"), (2, " ".join(f"w{n}" for n in range(1, 15)))],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(7, " ".join(f"w{n}" for n in range(14)))], "item_id long, text string")
    found = {tuple(r) for r in contamination.longest_matches(docs.coalesce(1), items).collect()}
    assert (1, 2, "7", 0, 12) in found and (2, 0, "7", 1, 13) in found


def test_language_of_held_out_documents(spark):
    langs = dict(rows_of("documents", "doc_id, lang"))
    held = [r for r in run(spark, "op10_language_id") if r.held_out]
    right = [r for r in held if r.lang_pred == langs[r.doc_id]]
    assert len(right) >= 0.9 * len(held)
    assert sum(r.rejected for r in held) <= 0.02 * len(held)


def test_quality_of_held_out_documents(spark):
    marks = dict(rows_of("labels", "doc_id, quality"))
    rows = [(r.score, marks[r.doc_id]) for r in run(spark, "op5_quality") if r.held_out and r.doc_id in marks]
    good, bad = ([s for s, q in rows if q == v] for v in (1, 0))
    wins = sum((g > b) + (g == b) / 2 for g in good for b in bad)
    assert not bad or wins >= 0.85 * len(good) * len(bad)


def test_neighbours_recall(spark):
    rows = rows_of("embeddings", "vec_id, embedding")
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    found = defaultdict(list)
    for r in run(spark, "op7_neighbours"):
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(found) == {i for i in ids.tolist() if i % 20 == 0}
    hits = total = 0
    place = {i: n for n, i in enumerate(ids.tolist())}
    for query, got in found.items():
        scores = vectors @ vectors[place[query]]
        scores[place[query]] = -np.inf
        hits += len(set(ids[np.argsort(-scores)[:20]].tolist()) & {v for _, v, _ in got})
        total += 20
        assert [r for r, _, _ in sorted(got)] == list(range(1, 21))
        assert all(abs(s - scores[place[v]]) < 1e-12 for _, v, s in got)
    assert hits >= 0.9 * total


def test_neighbours_off_the_origin(spark):
    """Vectors of mixed lengths around a point far from the origin."""
    from tickloom.llm import neighbours

    random = np.random.default_rng(6)
    vectors = (random.normal(size=(4000, 32)) + 2 * random.normal(size=32)) * random.uniform(0.3, 3, (4000, 1))
    frame = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = defaultdict(set)
    for r in neighbours.search(frame, "vec_id % 50 = 0").collect():
        found[r.query_id].add(r.vec_id)
    hits = 0
    for query, got in found.items():
        scores = vectors @ vectors[query]
        scores[query] = -np.inf
        hits += len(set(np.argsort(-scores)[:20].tolist()) & got)
    assert len(found) == 80 and hits >= 0.9 * 20 * 80


def slow_segments(text, vocab):
    known = {s: n for n, s in enumerate(vocab.spellings) if s and n not in set(vocab.byte_pieces.tolist())}
    text = " " + text
    best, back = [0.0] + [-1e300] * len(text), [None] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 16), end):
            piece = known.get(text[start:end].encode())
            if piece is not None or end - start == 1:
                score = best[start] + (vocab.unknown if piece is None else vocab.scores[piece])
                if score > best[end]:
                    best[end], back[end] = score, (start, piece)
    out = []
    while end:
        start, piece = back[end]
        out[:0] = [piece] if piece is not None else [int(vocab.byte_pieces[b]) for b in text[start:end].encode()]
        end = start
    return out


def test_pieces(spark, docs):
    vocab = pieces.vocabulary()
    texts = ["a", " ", "  hello   world", "the\nand € ▁x 🎉\t.", "x" * 500, "日本語 ñandú"]
    texts += [t[:800] for t in list(docs.values())[:30] if t]
    found, first = pieces.encode([t.encode() for t in texts], vocab)
    for n, text in enumerate(texts):
        assert found[first[n]: first[n + 1]].tolist() == slow_segments(text, vocab)
    rows = run(spark, "op8_sentencepiece")
    assert len(rows) == len(docs) and all(r.exact and r.n_tokens == len(r.tokens) for r in rows)
    tokens = np.array([t for r in rows for t in r.tokens])
    first = np.concatenate([[0], np.cumsum([r.n_tokens for r in rows])])
    again = pieces.decode_bytes(tokens, first, vocab)
    assert all(a.decode() == (docs[r.doc_id] or "") for a, r in zip(again, rows, strict=True))


def test_licenses(spark, docs):
    stated = {
        "MIT": "released under the mit license", "Apache-2.0": "licensed under the apache license version 2.0",
        "CC-BY-NC-4.0": "licensed under cc by-nc 4.0",
        "GPL-3.0": "licensed under the gnu general public license version 3",
    }
    expected = {
        (i, name) for i, text in docs.items() for name, words in stated.items()
        if words in re.sub(r"[,\s]+", " ", (text or "").lower())
    }
    found = run(spark, "op1_license_scan")
    assert {(r.doc_id, r.license_id) for r in found} == expected and expected
    assert all(r.saved_bytes > 0 and r.n_different == len(r.differences) for r in found)


def test_loser_tree():
    random = np.random.default_rng(3)
    for count in range(9):
        runs = [sorted(random.integers(0, 50, random.integers(0, 20)).tolist()) for _ in range(count)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(sum(runs, []))


def test_capture_order(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").repartition(5)
    from pyspark.sql import functions as F

    index = warc.write_runs(warc.with_originals(pages.withColumn("date", F.lit("2024-01-01"))))
    rows = warc.merged(index).orderBy("position").collect()
    keys = [(r.url_key, r.date, r.page_id) for r in rows]
    assert index.select("run").distinct().count() == 5 and keys == sorted(keys) and len(keys) == pages.count()


def test_pipeline(spark, docs):
    """Every stage against what stays by brute force, on its own input."""
    frame = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    spoken = stages["language_id"](spark, frame, SF_DIR)
    kept = {r.doc_id: r.text for r in spoken.collect()}
    assert len(kept) >= 0.98 * sum(bool(re.search(r"[^\W\d_]", t or "")) for t in docs.values())
    different = stages["near_dedup"](spark, spoken, SF_DIR)
    own = {i for i, (_, top) in components(kept).items() if i == top}
    assert {r.doc_id for r in different.collect()} == own
    clean = stages["decontamination"](spark, different, SF_DIR)
    dirty = {r.doc_id for r in run(spark, "op4_decontamination") if r.contaminated}
    assert {r.doc_id for r in clean.collect()} == own - dirty
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "n_bytes", "exact", "tokens"]
    assert out.where("NOT exact").count() == 0 and {r.doc_id for r in out.collect()} <= own
