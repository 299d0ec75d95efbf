import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from precis.llm import words as W
from precis.llm.xxh64 import xxh64

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbé中 \t\n\x0b\x1c .", max_size=30)), max_size=12)


def plain(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(0, 3), st.sampled_from([4, 1 << 20]))
def test_words_of_batches(texts, skip, size):
    array = pa.array([None] * skip + texts, pa.string()).slice(skip)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(W, "SLICE_BYTES", size)
        seen = {}
        rows = 0
        for part in W.slices(array):
            for r in range(len(part.bounds) - 1):
                a, b = part.first[r], part.first[r + 1]
                got = [part.data[s:e].tobytes() for s, e in zip(part.starts[a:b], part.ends[a:b], strict=True)]
                assert got == plain(texts[part.row + r])
                for word, h in zip(got, part.hashes[a:b].tolist(), strict=True):
                    assert seen.setdefault(word.lower(), h) == h
                rows += 1
    assert rows == len(texts)
    assert len(set(seen.values())) == len(seen)


def test_range_hashes():
    values = W.mix(np.arange(50, dtype=np.uint64) % np.uint64(7) + np.uint64(1))
    ranges = W.Range(values)
    by_content = {}
    for a in range(50):
        for b in range(a, 50):
            h = int(ranges.hash(np.array([a]), np.array([b]))[0])
            assert by_content.setdefault(tuple(values[a:b].tolist()), h) == h
    assert len(set(by_content.values())) == len(by_content)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=70), min_size=1, max_size=20), st.integers(0, 2**64 - 1))
def test_xxh64(parts, seed):
    ends = np.cumsum([len(p) for p in parts])
    lengths = np.array([len(p) for p in parts])
    got = xxh64(np.frombuffer(b"".join(parts), np.uint8), ends - lengths, lengths, seed)
    assert got.tolist() == [xxhash.xxh64_intdigest(p, seed) for p in parts]


def test_counted(spark):
    df = spark.createDataFrame([(1, " a\tb\n"), (2, None), (3, "")], "k long, t string")
    assert {r["k"]: r["n"] for r in W.counted(df, "t", "n").collect()} == {1: 2, 2: 0, 3: 0}
