"""Words, windows and their hashes against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tabulyst.llm.textbytes import ALNUM, NONSPACE, HashSet, chunks, run_hashes, split_words, utf8, windows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = st.lists(st.none() | st.text(alphabet="aB3 é.\n日-_", max_size=30), max_size=8)


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words(texts):
    data, offsets = utf8(pa.array(texts, pa.string()))
    for inside, pattern in ((ALNUM, WORD), (NONSPACE, re.compile(r"[^\x20\x09-\x0D]+"))):
        words = split_words(data, offsets, inside)
        found = [[words.raw[words.starts[i]:words.ends[i]].tobytes().decode() for i in range(a, b)] for a, b in zip(words.rows, words.rows[1:])]
        expected = [pattern.findall(ascii_lower(x or "")) for x in texts]
        assert found == expected
        flat = [x for row in expected for x in row]
        assert len(set(flat)) == len(set(words.hashes.tolist()))
        for n in (1, 3):
            first, hashes = windows(words, n)
            runs = [tuple(row[i:i + n]) for row in expected for i in range(len(row) - n + 1)]
            assert len(runs) == len(first) and len(set(runs)) == len(set(hashes.tolist()))


def test_run_hashes_tell_runs_by_content_and_length():
    data, offsets = utf8(pa.array(["a b c a b", "a b"]))
    words = split_words(data, offsets, ALNUM)
    low, high = np.array([0, 3, 5, 0, 1]), np.array([2, 5, 7, 3, 2])
    found = run_hashes(words, low, high).tolist()
    assert found[0] == found[1] == found[2] and len(set(found)) == 3


def test_long_rows_are_hashed_in_parts_alike():
    word = "x" * 3_000_000
    data, offsets = utf8(pa.array([f"{word} ab {word}", word, "ab"]))
    words = split_words(data, offsets, ALNUM)
    assert words.hashes[0] == words.hashes[2] == words.hashes[3] and words.hashes[1] == words.hashes[4]


def test_chunks_cover_all_rows():
    offsets = np.array([0, 5, 5, 9, 40, 41])
    assert list(chunks(offsets, 9)) == [(0, 3), (3, 4), (4, 5)]


def test_hash_set():
    known = HashSet(np.array([1 << 63, 5, 7], np.uint64))
    assert known.contains(np.array([5, 6, 1 << 63, 0], np.uint64)).tolist() == [True, False, True, False]
    assert not HashSet(np.empty(0, np.uint64)).contains(np.array([0, 5], np.uint64)).any()
