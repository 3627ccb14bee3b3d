import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from fundscope.llm import arrays as ar
from tests.llm import brute

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=" \t\nabcZ09é漢\x1c -", max_size=30)), max_size=12)


def flat(texts, limit=7):
    return list(ar.chunks(pa.array(texts, pa.string()), limit))


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_the_pattern(texts):
    got = []
    for row, end, data, offsets in flat(texts):
        w = ar.Words(data, offsets, ar.NON_SPACE)
        for d in range(end - row):
            got.append([bytes(data[w.start[k]: w.end[k]]).decode() for k in range(w.doc[d], w.doc[d + 1])])
    assert got == [brute.WORD.findall(t or "") for t in texts]


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_hashes_follow_the_words_and_their_sequences(texts):
    seen = {}
    for row, end, data, offsets in flat(texts, 1000):
        w = ar.Words(data, offsets, ar.NON_SPACE)
        h, seq = w.hashes(), ar.Sums(w.hashes())
        for a in range(len(w)):
            for b in range(a + 1, min(len(w), a + 3) + 1):
                name = tuple(bytes(data[w.start[k]: w.end[k]]) for k in range(a, b))
                value = int(seq(np.array([a]), np.array([b]))[0])
                assert seen.setdefault(name, value) == value
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_characters(texts):
    for row, end, data, offsets in flat(texts):
        value, bound = ar.characters(data, offsets, lower=False)
        for d, text in enumerate(texts[row:end]):
            want = [int.from_bytes(c.encode(), "little") for c in text or ""]
            assert value[bound[d]: bound[d + 1]].tolist() == want


def test_characters_lower_latin():
    text = "ÀÉÖ×ÞßAZaz".encode()
    value, _ = ar.characters(np.frombuffer(text, np.uint8), np.array([0, len(text)]), lower=True)
    assert value.tolist() == [int.from_bytes(c.encode(), "little") for c in "àéö×þßazaz"]


def test_distinct_and_ranges():
    assert ar.distinct(np.array([3, 1, 3, 2])).tolist() == [1, 2, 3]
    assert ar.distinct(np.zeros(0, np.int64)).tolist() == []
    assert ar.ranges(np.array([5, 9]), np.array([2, 3])).tolist() == [5, 6, 9, 10, 11]
    assert re.fullmatch(r"\d+", str(int(ar.mix(np.array([1], np.uint64))[0])))
