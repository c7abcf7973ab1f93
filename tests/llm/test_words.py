import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ordlog.llm import words

SPACED, ALNUM = re.compile(rb"[^\x20\x09-\x0D]+"), re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(), st.text("aB .\n\té0", max_size=30)), max_size=8)


def found(texts, kind):
    out = []
    for _, _, w in words.split_texts(pa.array(texts, pa.string()), kind):
        every = [w.text(i) for i in range(len(w.hashes))]
        out += [every[a:b] for a, b in zip(w.at, w.at[1:])]
    return out


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_the_runs_of_the_pattern(texts):
    for kind, pattern in ((words.SPACED, SPACED), (words.ALNUM, ALNUM)):
        want = [pattern.findall((t or "").encode().lower()) for t in texts]
        assert found(texts, kind) == want


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_equal_words_and_only_they_have_equal_hashes(texts):
    seen = {}
    for _, _, w in words.split_texts(pa.array(texts, pa.string()), words.SPACED):
        for i, h in enumerate(w.hashes.tolist()):
            assert seen.setdefault(w.text(i), h) == h
    assert len(set(seen.values())) == len(seen)


def test_hashes_do_not_depend_on_place_or_piece(monkeypatch):
    text = "one two " + "x" * 50 + " one two"
    whole = next(words.split_texts(pa.array([text]), words.SPACED))[2]
    monkeypatch.setattr(words, "PIECE", 16)
    pieces = next(words.split_texts(pa.array([text]), words.SPACED))[2]
    assert whole.hashes.tolist() == pieces.hashes.tolist()
    assert whole.hashes[0] == whole.hashes[3] == words.hash_word("ONE")
    assert whole.second(np.array([0, 3]))[0] == whole.second(np.array([0, 3]))[1]


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 9])
def test_shingles_are_distinct_runs_of_words(n):
    text = " ".join("abcabcabc"[:n])
    w = next(words.split_texts(pa.array([text]), words.SPACED))[2]
    (s,) = words.shingle_sets(w, 5)
    parts = text.split()
    want = {tuple(parts[i : i + 5]) for i in range(max(1, n - 4))} if n else set()
    assert len(s) == len(want) and (s[1:] > s[:-1]).all()


def test_a_short_sequence_is_no_shingle_of_a_longer_one():
    w = next(words.split_texts(pa.array(["a b c d", "a b c", "a b c d e"]), words.SPACED))[2]
    sets = words.shingle_sets(w, 5)
    assert len({int(s[0]) for s in sets}) == 3


def test_rows_are_taken_some_at_a_time():
    texts = ["ab cd"] * 10 + ["x" * 100] + ["ef"] * 3
    _, at = words.buffer(pa.array(texts))
    ranges = list(words.chunks(at, 12))
    assert ranges[0][0] == 0 and ranges[-1][1] == 14
    assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))
