"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import (
    chat, contamination, language, licenses, near_dup, neighbours, passages, pieces, quality, warc,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["row", "id", "key", "component", "kept", "score", "tokens", "n_words", "rejected", "left", "cut_id"]
PROSE = " ".join(f"word{n % 37} other{n % 11} thing{n}" for n in range(60))
LONG = " ".join(f"w{n}" for n in range(120_000))


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", len(t or "")) for i, t, g in rows], DOCS)


@pytest.fixture(scope="module")
def edge(spark):
    rows = [
        (1, None, "en"), (2, "", "en"), (3, "   \n\t ", None), (4, "12 34 !!", "en"), (5, PROSE, "en"),
        (5, PROSE, "en"), (6, PROSE, None), (7, "one two", "en"), (8, "ONE two", "de"), (9, LONG, "en"),
        (None, PROSE, "en"), (None, None, None), (10, "é ü ▁ \x00 <|im_end|>", "fr"),
    ]
    frame = docs_of(spark, rows)
    for name in CLASH:
        frame = frame.withColumn(name, F.lit("mine"))
    return frame


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(1, "thing1 word2 other2 thing2 word3 other3 thing3 word4 other4 thing4 word5"), (2, None), (3, ""), (None, "x")],
        "item_id long, text string",
    )


def by_id(frame, *columns):
    return sorted((tuple(r[c] for c in ("doc_id", *columns)) for r in frame.collect()), key=repr)


def test_near_duplicates(edge, empty):
    found = by_id(near_dup.near_duplicates(edge), "component_id", "kept")
    assert len(found) == edge.count()
    assert {(1, 1, True), (2, 2, True), (3, 3, True), (5, 5, True), (6, 5, False), (7, 7, True), (8, 7, False)} <= set(found)
    assert [f for f in found if f[0] is None] == [(None, 5, True), (None, None, True)]
    assert near_dup.near_duplicates(empty).count() == 0


def test_passages(edge, empty):
    found = by_id(passages.passages(edge), "place", "n_words", "kept")
    assert found == [(5, 0, 180, True), (6, 0, 180, False)]
    left = passages.without_repeats(edge)
    assert left.columns == edge.columns
    assert sorted(r.doc_id for r in left.where("doc_id IS NOT NULL").collect()) == [1, 2, 3, 4, 5, 5, 7, 8, 9, 10]
    assert left.where("doc_id IS NULL").count() == 2
    assert passages.passages(empty).count() == 0
    assert passages.without_repeats(empty).count() == 0


def test_contamination(edge, empty, items):
    found = contamination.contamination(edge, items)
    rows = by_id(found.select("row.doc_id", "contaminated", "n_words"), "contaminated", "n_words")
    assert [r[0] for r in rows if r[1]] == [5, 5, 6, None]
    assert (1, False, 0) in rows and (2, False, 0) in rows and (9, False, 120_000) in rows
    assert contamination.decontaminated(edge, items).columns == edge.columns
    assert contamination.contamination(empty, items).count() == 0
    nothing = items.where("false")
    assert contamination.decontaminated(edge, nothing).count() == edge.count()


def test_language(edge, empty):
    model = language.learned(edge)
    rows = by_id(language.identified(edge, model).select("row.doc_id", "lang_pred", "rejected"), "lang_pred", "rejected")
    assert {(i, "und", True) for i in (1, 2, 3, 4)} <= set(rows)
    assert all(r[1] in ("en", "de", "fr") for r in rows if r[0] in (5, 6, 7, 8, 9, 10))
    nothing = language.learned(empty)
    assert language.identified(empty, nothing).count() == 0
    assert {r.lang_pred for r in language.identified(edge, nothing).collect()} == {"und"}


def test_numerals_are_no_letters(spark, edge):
    model = language.learned(edge)
    texts = ["½", "²³", "①", "12_", "ⅷ", "日", "ª"]
    rows = docs_of(spark, [(n, t, None) for n, t in enumerate(texts)])
    found = {r.doc_id: r.lang_pred for r in language.identified(rows, model).select("row.doc_id", "lang_pred").collect()}
    assert [found[n] == "und" for n in range(7)] == [True, True, True, True, True, False, False]


def test_pieces(edge, empty):
    vocab = pieces.vocabulary()
    rows = pieces.encoded(edge, vocab)
    assert rows.where("NOT exact").count() == 0
    assert rows.where("row.text IS NULL OR row.text = ''").agg(F.sum("n_tokens")).first()[0] == 0
    again = pieces.decoded(rows.select("row.text", "tokens"), vocab)
    assert again.where("NOT (decoded <=> coalesce(text, ''))").count() == 0
    assert pieces.encoded(empty, vocab).count() == 0


def test_licenses(spark, empty):
    rows = [
        (1, None, ""), (2, "", ""), (3, "x\nReleased under the MIT License.\ny", ""),
        (3, "x\nReleased under the MIT License.\ny", ""), (None, "licensed under cc by-nc 4.0", ""),
        (4, "A license is a license.", ""), (5, LONG + "\nReleased under MIT License.", ""),
        (6, "Released under the MIT License.\nLicensed under the Apache License, Version 2.0.", ""),
    ]
    found = by_id(licenses.scan(docs_of(spark, rows)), "license_id", "n_different", "first_line")
    assert found == sorted(
        [(3, "MIT", 0, 1), (3, "MIT", 0, 1), (None, "CC-BY-NC-4.0", 0, 0), (5, "MIT", 1, 1), (6, "MIT", 0, 0),
         (6, "Apache-2.0", 0, 0)], key=repr,
    )
    assert licenses.scan(empty).count() == 0


def test_quality(spark, edge, empty):
    labels = spark.createDataFrame(
        [(5, 1, 0), (5, 1, 0), (7, 0, 0), (8, 0, 0), (9, 1, 0), (None, 1, 0), (4, None, 0), (6, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    vectors = quality.word_vectors(edge)
    rows = quality.scored(edge, quality.fit(edge, labels, vectors), vectors).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    nothing = quality.word_vectors(empty)
    assert quality.fit(empty, labels.where("false"), nothing) is None
    assert quality.scored(empty, None, nothing).count() == 0
    assert {r.score for r in quality.scored(edge, None, nothing).collect()} == {0.5}


def test_neighbours(spark):
    schema = "vec_id long, embedding array<float>, label int"
    rows = [
        (0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, None, 0), (4, [0.0, 0.0], 0),
        (5, [None, 1.0], 0), (6, [float("nan"), 1.0], 0), (7, [float("inf"), 1.0], 0), (8, [1.0, 2.0, 3.0], 0),
        (None, [1.0, 1.0], 0), (20, [0.0, 1.0], 0), (9, [0.5, 0.5], 0), (9, [0.5, 0.5], 0),
    ]
    found = neighbours.search(spark.createDataFrame(rows, schema), "vec_id % 20 = 0", count=3)
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in found.orderBy("query_id", "rank").collect()]
    assert got == [
        (0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 9, 0.5), (20, 1, 9, 0.5), (20, 2, 9, 0.5), (20, 3, 0, 0.0),
    ]
    assert neighbours.search(spark.createDataFrame([], schema), "vec_id % 20 = 0").count() == 0


def test_archives(spark):
    long = "y" * 3_000_000
    rows = [
        (3, "http://b.org/x", "p" * 100), (2, "http://www.b.org/x", "p" * 100), (1, "http://a.org", "p" * 99),
        (4, None, None), (5, "http://b.org/x", "p" * 99), (None, "u\r\nv", "p" * 100), (6, "", ""), (7, "x", long),
        (8, "x", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc"), (2, "http://b.org/x", "p" * 100),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("mine"))
    date = F.lit("2024-01-01T00:00:00Z")
    found = warc.archived(pages, date).orderBy("position").collect()
    got = [(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in found]
    assert sorted(got, key=repr) == sorted([
        (3, 100, "revisit", 2), (2, 100, "response", None), (1, 99, "response", None), (4, 0, "response", None),
        (5, 99, "response", None), (None, 100, "revisit", 2), (6, 0, "response", None), (7, len(long), "response", None),
        (8, 34, "response", None), (2, 100, "response", None),
    ], key=repr)
    assert warc.archived(pages.where("false"), date).count() == 0


def test_chat(spark):
    rows = [
        (1, 1, "assistant", None), (1, 0, "user", "<|im_start|>\\<\\|x"), (1, 1, "assistant", "b<|im_end|>"),
        (None, None, None, None), (2, 0, "a\nb\\", "x" * 1_000_000),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit(1))
    found = {r.conv_id: r for r in chat.read_back(chat.formatted(chat.text_parts(turns))).collect()}
    import hashlib

    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert found[1].turns_sha256 == digest("user\n<|im_start|>\\<\\|x\nassistant\n\nassistant\nb<|im_end|>\n")
    assert (found[1].loss_chars, found[1].loss_sha256) == (11, digest("b<|im_end|>"))
    assert found[2].turns_sha256 == digest("a\nb\\\n" + "x" * 1_000_000 + "\n")
    assert found[None].turns_sha256 == digest("\n\n") and found[None].n_turns == 1
    assert chat.read_back(chat.formatted(chat.text_parts(turns.where("false")))).count() == 0


def test_chat_parts(spark):
    """Placeholders, attachments and expanded tokens of all types; null parts, types and odd sizes."""
    names = ("type", "text", "ref", "width", "height", "seconds", "pages")
    part = lambda **given: tuple(given.get(n) for n in names)
    parts = [
        part(type="text", text="see <|image|>"), None, part(type="image", ref="i", width=57, height=28), part(),
        part(type="audio", ref="a", seconds=1.5), part(type="audio", ref="n", seconds=float("nan")),
        part(type="document", ref="d", pages=3), part(type="image", ref="z", width=-5, height=9), part(type="text"),
    ]
    rows = [(1, 0, "user", parts), (1, 1, "assistant", [part(type="text", text="ok")]), (1, 2, "user", None)]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    found = chat.formatted(turns).orderBy("turn").collect()
    shown = "see <\\|image|><|image|><|audio|><|audio|><|document|><|image|>"
    assert found[0].segment == f"<|im_start|>user\n{shown}<|im_end|>\n"
    assert [tuple(a) for a in found[0].attachments] == [
        (0, "image", "i", 3), (1, "audio", "a", 38), (2, "audio", "n", 0), (3, "document", "d", 768), (4, "image", "z", 0),
    ]
    assert [(r.n_tokens, r.loss_length) for r in found] == [(809, 0), (0, 2), (0, 0)]
    unknown = spark.createDataFrame([(1, 0, "user", [part(type="video")])], turns.schema)
    with pytest.raises(Exception, match="no such type"):
        chat.formatted(unknown).collect()


def test_pipeline_stages(spark, edge, empty, items, tmp_path):
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
        out = stage(spark, edge, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == edge.columns
        assert out.count() > 0
