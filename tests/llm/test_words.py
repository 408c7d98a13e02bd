import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from quillstream.llm import words as W

ALPHABET = st.text(st.sampled_from("ab é\t\n\x0b\x1c\x85Z9.,😀"), max_size=60)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), ALPHABET), max_size=12), st.integers(1, 40))
def test_words_equal_regex(column, limit):
    for table, pattern, fold in ((W.NOT_SPACE, rb"[^\x20\x09-\x0d]+", False), (W.ALNUM, rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", True)):
        got = []
        for low, high, flat in W.texts(pa.array(column, pa.string()), table, fold, limit):
            for r in range(high - low):
                a, b = flat.first[r], flat.first[r + 1]
                got.append([flat.data[s:e].tobytes() for s, e in zip(flat.start[a:b], flat.end[a:b])])
        assert got == [re.findall(pattern, (t or "").encode().lower() if fold else (t or "").encode()) for t in column]


def test_hash_depends_on_content_only():
    flat = W.cut(*(lambda b: (np.frombuffer(b, np.uint8), np.array([0, len(b)])))(b"aa bb aa ab ba aa bb aa"))
    assert flat.hash[0] == flat.hash[2] and len(set(flat.hash.tolist())) == 4
    at, key = W.windows(flat, 3)
    assert len(at) == 6 and key[0] == key[5] and len(set(key.tolist())) == 5


def test_lines_of_rows():
    text = [b"a\nb\n", b"", b"\n", b"c"]
    offset = np.cumsum([0, *map(len, text)])
    start, end, first = W.lines(np.frombuffer(b"".join(text), np.uint8), offset)
    data = b"".join(text)
    got = [[data[s:e] for s, e in zip(start[a:b], end[a:b])] for a, b in zip(first[:-1], first[1:])]
    assert got == [t.split(b"\n") for t in text]


def test_slice_of_a_column():
    column = pa.array(["skip", "a b", None, "c"]).slice(1, 3)
    (low, high, flat), = W.texts(column)
    assert (low, high) == (0, 3) and flat.first.tolist() == [0, 2, 2, 3]


def thue_morse(n, a, b):
    """Two words of 2**n letters that agree under any sum of powers modulo 2**64."""
    x = [bin(i).count("1") % 2 for i in range(2**n)]
    return bytes((a, b)[i] for i in x), bytes((b, a)[i] for i in x)


def test_thue_morse_words_differ():
    for n in (10, 12, 13):
        for a, b in (b"ab", b"a!", b"\x80z"):
            x, y = thue_morse(n, a, b)
            data, bound = np.frombuffer(x + y + x, np.uint8), np.arange(4) * 2**n
            for other in (False, True):
                h = W.byte_hashes(data, bound[:-1], bound[1:], other)
                assert h[0] == h[2] != h[1]
            assert W.byte_numbers(data, bound[:-1], bound[1:]).tolist() == [0, 1, 0]


def test_byte_numbers_of_any_spans():
    data = np.frombuffer(b"abcabxabc", np.uint8)
    start, end = np.array([0, 3, 6, 2, 2, 0, 6]), np.array([3, 6, 9, 2, 2, 2, 8])
    assert W.byte_numbers(data, start, end).tolist() == [0, 1, 0, 2, 2, 3, 3]
    assert W.byte_hashes(data, start, end)[[0, 3, 5]].tolist() == W.byte_hashes(data, start, end)[[2, 4, 6]].tolist()
    assert len(W.byte_numbers(data, start[:0], end[:0])) == len(W.byte_hashes(data, start[:0], end[:0])) == 0


def test_prefix_hashes():
    data = np.frombuffer(b"abcdefg abcdexx abcde abc", np.uint8)
    flat = W.cut(data, np.array([0, len(data)]))
    (every, whole), (longer, stem) = W.prefix_hashes(flat.data, flat.start, flat.end, (5,))
    assert every.tolist() == [0, 1, 2, 3] and longer.tolist() == [0, 1]
    assert whole.tolist() == flat.hash.tolist() and stem[0] == stem[1] and not set(stem.tolist()) & set(whole.tolist())
