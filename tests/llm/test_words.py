import hashlib
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from nightledger.llm import packed
from nightledger.llm.words import ALNUM, SPACED, Words, buffers, slabs, window_hashes, window_starts

TEXT = st.lists(st.text(alphabet="aBz9é漢 \t\n\v\f\r.-\x00", max_size=40), max_size=8)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_words_are_those_of_the_patterns(texts):
    data, offsets = buffers(pa.array(texts, pa.string()))
    for table, pattern in ((SPACED, r"[^\x20\x09-\x0D]+"), (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        words = Words(data, offsets, table, lower=True)
        want = [re.findall(pattern, lower(t)) for t in texts]
        assert words.counts.tolist() == [len(w) for w in want]
        assert [words.word(i).decode() for i in range(len(words))] == [x for w in want for x in w]


def test_hashes_depend_on_the_word_only():
    texts = ["alpha beta alpha", "beta " + "x" * 200, "x" * 200 + " alpha", "x" * 199]
    data, offsets = buffers(pa.array(texts))
    words = Words(data, offsets, SPACED)
    by_word = {}
    for which in (0, 1):
        for i, h in enumerate(words.hashes(which)):
            assert by_word.setdefault((which, words.word(i)), h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_windows_stay_inside_texts():
    data, offsets = buffers(pa.array(["a b c d", "a b c", None, "", "a b c d"]))
    words = Words(data, offsets, SPACED)
    starts = window_starts(words, 3)
    keys = window_hashes(words.hashes(), starts, 3)
    assert words.text_of()[starts].tolist() == [0, 0, 1, 4, 4]
    assert keys[0] == keys[2] == keys[3] and keys[1] == keys[4] and keys[0] != keys[1]


def test_slabs_cover_sliced_columns():
    texts = [None, "", "abc", "d" * 50, "ef", None, "g"]
    column = pa.array(["skip", *texts]).slice(1)
    got = []
    for lo, hi, data, offsets in slabs(column, 5):
        assert hi > lo
        got += [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    assert got == [t or "" for t in texts]


def test_pack_round_trip():
    arrays = [np.arange(-5, 5), np.empty(0, np.uint32), np.array([7, 7, 9], np.uint8), np.linspace(0, 1, 4)]
    out = packed.unpack(packed.pack(*arrays))
    assert all(a.dtype == b.dtype and a.tolist() == b.tolist() for a, b in zip(arrays, out, strict=True))
    values = np.array([3, 4, 9, 2], np.int32)
    assert np.cumsum(packed.steps(values)).tolist() == values.tolist()


def test_long_words_differ_by_one_byte():
    base = "q" * 300
    texts = [base, base[:-1] + "r", "r" + base[1:]]
    data, offsets = buffers(pa.array(texts))
    assert len(set(Words(data, offsets, SPACED).hashes().tolist())) == 3
    assert hashlib.blake2b(base.encode(), digest_size=16).digest()[:8] == Words(data, offsets, SPACED).hashes()[0].tobytes()
