"""Array helpers against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from pulsefold.llm import texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
some_texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b\x1c 漢A", max_size=30)), min_size=1, max_size=6)


@given(some_texts)
@settings(max_examples=60, deadline=None)
def test_words_and_hashes(rows):
    words = texts.cut(pa.array(rows, pa.string()))
    want = [(d, w) for d, t in enumerate(rows) for w in WORD.findall(t or "")]
    got = [(int(d), words.data[a:b].tobytes().decode()) for d, a, b in zip(words.doc, words.starts, words.ends)]
    assert got == want
    hashes = words.hashes()
    assert len(set(hashes.tolist())) == len({w for _, w in want})
    assert [x.decode() for x in texts.joined(words, np.ones(len(want), bool))] == [" ".join(WORD.findall(t or "")) for t in rows]


@given(some_texts)
@settings(max_examples=60, deadline=None)
def test_beginnings_of_words(rows):
    words = texts.cut(pa.array(rows, pa.string()))
    for n, at, hashes in words.prefixes((2, 3, 5)):
        assert at.tolist() == np.flatnonzero(words.ends - words.starts > n).tolist()
        assert hashes.tolist() == words.hashes(n)[at].tolist()


@given(some_texts, st.integers(1, 4))
@settings(max_examples=60, deadline=None)
def test_ngrams(rows, n):
    words = texts.cut(pa.array(rows, pa.string()))
    lists = [WORD.findall(t or "") for t in rows]
    want = [tuple(w[i:i + n]) for w in lists for i in range(len(w) - n + 1)]
    for make in (texts.ngrams, texts.long_ngrams):
        got, at = make(words, words.hashes(), n)
        assert len(got) == len(want) and len(set(got.tolist())) == len(set(want))
        assert len({(g, w) for g, w in zip(got.tolist(), want)}) == len(set(want))


def test_sliced_arrays_and_runs():
    column = pa.array(["zero", "one two", None, "three"]).slice(1)
    words = texts.cut(column)
    assert words.doc.tolist() == [0, 0, 2]
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 50, "b" * 500, "", "c"])], ["text"])
    assert [len(x) for x in texts.slices(iter([batch]), "text", 100)] == [1, 1, 2]
    assert texts.spread(np.array([5, 0, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]
