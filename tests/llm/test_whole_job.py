"""Cases in which an operator once did less than its whole job."""

import random
import string
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import language, licenses, passages

DOCS = "doc_id long, text string"
PROSE = (
    "the river runs along old walls and people walk there in the morning to see boats that come from far away "
    "with wood or stone while children play and somebody sells bread at a small table near water"
).split()


def prose(count, seed):
    return random.Random(seed).choices(PROSE, k=count)


@pytest.mark.parametrize("count", [500, 2_000, 20_000])
def test_license_in_a_long_line(spark, count):
    rows = []
    for number, template in enumerate(licenses.templates()):
        around = prose(count, number)
        around.insert(random.Random(number).randrange(count), template.text)
        rows.append((number, " ".join(around)))
    found = licenses.scan(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id, r.license_id, r.n_different) for r in found) == [
        (number, template.license_id, 0) for number, template in enumerate(licenses.templates())
    ]
    assert all(r.saved_bytes > 0 for r in found)


@pytest.mark.parametrize("width", [20, 40, 60, 72, 78])
def test_license_in_wrapped_lines(spark, width):
    """The first and last lines of a wrapped notice hold no stem; so may lines above and below it."""
    rows, wrapped = [], {}
    for number, template in enumerate(licenses.templates()):
        wrapped[number] = ["# " + line for line in textwrap.wrap(template.text, width, break_on_hyphens=False, break_long_words=False)]
        around = textwrap.wrap(" ".join(prose(120, number)), width)
        rows.append((number, "\n".join(around + wrapped[number] + around)))
        rows.append((100 + number, "\n".join(wrapped[number])))
    found = licenses.scan(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id, r.license_id, r.n_different) for r in found) == sorted(
        (number + more, template.license_id, 0)
        for number, template in enumerate(licenses.templates()) for more in (0, 100)
    )
    assert all(r.n_lines == len(wrapped[r.doc_id % 100]) for r in found)


def test_licenses_near_each_other_are_found_once(spark):
    one = "Released under the MIT License."
    apart = "\n".join(prose(8, 1))
    rows = [(1, f"{one}\n{apart}\n{one}"), (2, f"{one}\n" + "\n".join(prose(300, 2)) + f"\n{one}")]
    found = licenses.scan(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id, r.first_line, r.n_lines) for r in found) == [(1, 0, 1), (1, 9, 1), (2, 0, 1), (2, 301, 1)]


# The first article of the declaration of human rights.
UNLEARNED = {
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja "
          "omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "hu": "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel "
          "bírván, egymással szemben testvéri szellemben kell hogy viseltessenek.",
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i "
          "sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    "zh": "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心,并应以兄弟关系的精神相对待。",
}


def test_texts_of_no_learned_language_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = language.learned(docs)
    letters = random.Random(5)
    texts = [t * times for t in UNLEARNED.values() for times in (1, 5, 50)]
    texts.append(" ".join("".join(letters.choices(string.ascii_lowercase, k=letters.randint(2, 10))) for _ in range(200)))
    texts.append("".join(letters.choices(string.ascii_letters + string.digits + "+/", k=5_000)))
    names, scores, rejected = model.predict([t.encode() for t in texts])
    assert rejected.all(), [(t[:20], n, s) for t, n, s, r in zip(texts, names, scores, rejected, strict=True) if not r]
    held = language.identified(docs.where(language.held_out()), model).where(F.col("row.text").rlike(r"\p{L}"))
    assert held.where("rejected").count() <= 0.005 * held.count()


def test_one_short_text_does_not_set_the_floor_of_long_ones():
    score = np.concatenate([[0.05], np.full(150, 0.4), np.full(150, 0.9)])
    length = np.concatenate([[3], np.full(150, 5), np.full(150, 12)])
    floors = language.floors_of(score, length)
    assert floors[12] > 0.4 and 0.1 < floors[5] < 0.3


def test_all_training_texts_vote_for_the_language_of_a_centroid(spark):
    """An equal share of each language fits: 40 of the rare one, and 10 of the 100 of the common one."""
    near, far = "alpha beta gamma delta epsilon", "sunt quot homines tot sententiae suo quoique mos"
    rows = [("rare", near)] * 40 + [("common", near)] * 100 + [("common", far)] * 300
    frame = spark.createDataFrame([(n, t, g) for n, (g, t) in enumerate(rows)], DOCS + ", lang string")
    model = language.fit(frame, fit_rows=40)
    assert model.predict([near.encode()])[0] == ["common"]


def test_edited_copy_of_a_wrapped_paragraph(spark):
    """240 words in lines of 12 with one word of 42 changed: no 50 equal words in a row, no line of 50."""
    text = [f"word{n}" for n in range(240)]
    edited = [f"other{n}" if n % 42 == 41 else w for n, w in enumerate(text)]

    def lines(words):
        return "\n".join(" ".join(words[n: n + 12]) for n in range(0, len(words), 12))

    rows = [
        (1, f"head of one\n\n{lines(text)}\n \nend of one"), (2, f"two begins\nhere\n\n{lines(edited)}\n\n\nend of two"),
        (3, f"three\n\n{' '.join(edited)}"), (4, lines(text[:40])),
    ]
    frame = spark.createDataFrame(rows, DOCS)
    found = set(map(tuple, passages.passages(frame).drop("text_id").collect()))
    # The second holds the first one's by likeness, and what the third copies word by word.
    assert found == {(1, 3, 240, 1, True), (2, 3, 240, 1, False), (2, 3, 240, 2, True), (3, 1, 240, 1, False)}
    left = {r.doc_id: r.text for r in passages.without_repeats(frame).collect()}
    assert left[1] == rows[0][1] and left[4] == rows[3][1]
    assert left[2].split() == "two begins here end of two".split() and left[3] == "three"
