import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lexstrata.llm import kernels as k

from .conftest import TWINS

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\té\x0b\x1cñ ", max_size=30)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words(texts):
    data, offs = k.strings(pa.array(texts, pa.string()))
    w = k.Words(data, offs)
    raw = data.tobytes()
    got = [[raw[a:b].decode() for a, b in zip(w.start[i:j], w.end[i:j])] for i, j in zip(w.first[:-1], w.first[1:])]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    by_hash = {}
    for word, h in zip((x for row in got for x in row), w.hashes().tolist()):
        assert by_hash.setdefault(word, h) == h
    assert len(set(by_hash.values())) == len(by_hash)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=60), st.integers(1, 9))
def test_sliding_min(values, size):
    x = np.array(values, np.uint64)
    assert k.sliding_min(x, size).tolist() == [min(values[i : i + size]) for i in range(len(values) - size + 1)]


def test_blocks_cover_rows_and_slices():
    column = pa.array(["a" * 10, None, "", "b" * 30, "c"]).slice(1)
    rows = [(lo, hi) for lo, hi, _, _ in k.blocks(column, 8)]
    assert rows[0][0] == 0 and rows[-1][1] == 4 and all(a[1] == b[0] for a, b in zip(rows, rows[1:]))
    assert b"".join(d.tobytes() for _, _, d, _ in k.blocks(column, 8)) == b"b" * 30 + b"c"


def test_regular_words_have_hashes_of_their_own():
    data, offs = k.strings(pa.array(TWINS))
    for which in (0, 1):
        assert len(set(k.Words(data, offs).hashes(which=which).tolist())) == len(TWINS)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab\0é", max_size=20), min_size=1, max_size=8), st.randoms())
def test_equal_spans(texts, rnd):
    data, offs = k.strings(pa.array(texts))
    i = np.array([rnd.randrange(len(texts)) for _ in range(10)])
    j = np.array([rnd.randrange(len(texts)) for _ in range(10)])
    size = np.minimum(np.diff(offs)[i], np.diff(offs)[j])
    raw = [t.encode() for t in texts]
    want = [raw[a][:n] == raw[b][:n] for a, b, n in zip(i, j, size)]
    assert k.equal_spans(data, offs[i], data, offs[j], size).tolist() == want
    h = k.span_hashes(data, offs[:-1], offs[1:]).tolist()
    assert len(set(zip(h, raw))) == len(set(h)) == len(set(raw))
