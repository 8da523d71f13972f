"""License scans against every template held against every stretch."""

import random

import pytest

from tickloom.llm import licenses

PROSE = "the river runs along old walls and people walk there in the morning to see boats from far away".split()


def mutated(words, count, draw):
    words = list(words)
    for _ in range(count):
        place, kind = draw.randrange(len(words)), draw.randrange(3)
        words[place: place + (kind != 1)] = [] if kind == 2 else ["changed"]
    return words


@pytest.mark.parametrize("seed", range(6))
def test_notices_with_differences(seed):
    """What brute force over all words finds is found; the winner differs no more than any other."""
    for template in licenses.templates():
        draw = random.Random(f"{seed} {template}")
        notice = mutated(template.text.split(" "), draw.randrange(template.spare + 2), draw)
        text = "\n".join([" ".join(draw.choices(PROSE, k=draw.randrange(60))), " ".join(notice), *draw.choices(PROSE, k=50)])
        words = licenses.spelled(text)
        exact = {t: licenses.closest(t.words, words)[0] for t in licenses.templates()}
        near = {(t.license_id, n) for t, n in exact.items() if n <= t.spare}
        found = [(f[2], f[5]) for f in licenses.stated(text)]
        assert len(found) == bool(near)
        assert set(found) <= near
        if exact[template] == 0:
            assert found == [(template.license_id, 0)]


def test_ranks_by_bytes_saved():
    text = "Released under the MIT License."
    ranked = licenses.ranked(text)
    assert len(ranked) == len(licenses.templates()) and ranked[0][1].text == text
    assert [r[0] for r in ranked] == sorted((licenses.saved_bytes(text, t) for t in licenses.templates()), reverse=True)


def test_no_word_is_needed():
    """A notice is found whichever of its words is misspelt."""
    for template in licenses.templates():
        parts = template.text.split(" ")
        for place in range(len(parts)):
            text = " ".join([*PROSE, *parts[:place], "misspelt", *parts[place + 1:], *PROSE])
            assert len(list(licenses.stated(text))) == 1, (template.text, place)


def test_texts_without_blocks():
    assert not list(licenses.stated("")) and not list(licenses.stated(" ".join(PROSE * 1000)))
    assert not list(licenses.stated("license " * 500))
