import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tideline.llm import tokens

texts = st.lists(st.one_of(st.none(), st.text(alphabet="abÉß1_ \n.-\U0001f600", max_size=30)), max_size=8)


def split(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


@given(texts)
@settings(max_examples=200, deadline=None)
def test_words_are_told_apart_as_strings_are(many):
    hashes, bounds = tokens.words(many)
    mine = [hashes[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    theirs = [split(t) for t in many]
    assert [len(x) for x in mine] == [len(x) for x in theirs]
    pairs = {(h, w) for hs, ws in zip(mine, theirs, strict=True) for h, w in zip(hs, ws, strict=True)}
    assert len(pairs) == len({h for h, _ in pairs}) == len({w for _, w in pairs})


@given(texts, st.integers(1, 4))
@settings(max_examples=200, deadline=None)
def test_shingles_stay_within_a_text(many, size):
    hashes, bounds = tokens.words(many)
    mine, edges = tokens.text_shingles(hashes, bounds, size)
    theirs = []
    for t in many:
        w = split(t)
        k = min(size, len(w))
        theirs.append([tuple(w[i : i + k]) for i in range(len(w) - k + 1)] if k else [])
    assert np.diff(edges).tolist() == [len(x) for x in theirs]
    flat = [s for own in theirs for s in own]
    pairs = set(zip(mine.tolist(), flat, strict=True))
    assert len(pairs) == len({h for h, _ in pairs}) == len({s for _, s in pairs})


def test_slices_cover_all_texts():
    many = ["a" * n for n in (3, 0, 9, 2, 2)] + [None]
    assert list(tokens.slices(many, 5)) == [(0, 2), (2, 3), (3, 6)]
    assert list(tokens.slices([], 5)) == []
