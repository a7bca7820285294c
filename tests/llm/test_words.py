"""Text kernels: words, windows, units."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tempora.llm import arrays as A
from tempora.llm.units import UnitCache, ranges

TEXTS = st.lists(st.text(st.one_of(st.sampled_from("ab \t\n\x0b\x0c\r.é"), st.characters(blacklist_categories=["Cs"])), max_size=30), max_size=6)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    data, offsets = A.utf8(pa.array([*texts, None], pa.string()))
    words = A.Words(data, offsets, 0, len(texts) + 1)
    raw = words.data.tobytes()
    found = [[] for _ in range(len(texts) + 1)]
    for s, e, r in zip(words.starts, words.ends, words.row, strict=True):
        found[r].append(raw[s:e].decode())
    assert found == [re.findall(r"[^\x20\x09-\x0D]+", t) for t in [*texts, ""]]


def test_hashes_tell_content_not_place():
    data, offsets = A.utf8(pa.array(["a b c a b", "zz a b c"]))
    words = A.Words(data, offsets, 0, 2)
    h = words.hashes()
    assert h[0] == h[3] == h[6] and len(set(h.tolist())) == 4
    sums = A.prefix_sums(h)
    w = A.window_hashes(sums, words.window_starts(2), 2)
    assert len(w) == 7 and w[0] == w[3] == w[5]


def test_slices_cover_all_rows_and_bound_their_bytes():
    offsets = np.array([0, 5, 5, 30, 31, 40])
    parts = list(A.slices(offsets, 10))
    assert [x for i, j in parts for x in range(i, j)] == list(range(5))
    assert all(j - i == 1 or offsets[j] - offsets[i] <= 10 for i, j in parts)


def test_sliced_and_chunked_columns():
    column = pa.chunked_array([pa.array(["x", None, "yy"]).slice(1), pa.array(["z"])])
    data, offsets = A.utf8(column)
    assert A.strings(data, offsets).to_pylist() == ["", "yy", "z"]


def test_unit_cache_survives_clearing():
    cache = UnitCache(np.int64, most=4)
    for _ in range(3):
        keys = np.array([5, 7, 5, 9], np.uint64)
        slots = cache.slots(keys, lambda at: (np.repeat(keys[at].astype(np.int64), 2), np.full(len(at), 2)))
        assert cache.gather(slots)[0].tolist() == [5, 5, 7, 7, 5, 5, 9, 9]
        other = np.array([1, 2, 3], np.uint64)
        assert cache.gather(cache.slots(other, lambda at: (other[at].astype(np.int64), np.ones(len(at), np.int64))))[0].tolist() == [1, 2, 3]


def test_ranges():
    flat, ends = ranges(np.arange(10), np.array([3, 0, 8]), np.array([2, 0, 1]))
    assert flat.tolist() == [3, 4, 8] and ends.tolist() == [2, 2, 3]
