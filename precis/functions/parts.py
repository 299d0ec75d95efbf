"""Sentences, words and tokens of many texts at once, as in ``text.py``, for use inside Arrow batches.

Texts are handled in slices of about a megabyte (a longer text makes a slice of its
own), so memory follows the longest text and not the batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20


def _among(values: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(values)] = True
    return out


_GAP, _MARK = _among(b" \t\n\r\f"), _among(b".!?")
_SPACE = _among(b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f ")
# First bytes of the spaces beyond ASCII.
_WIDE = _among(b"\xc2\xe1\xe2\xe3")
_IN_TOKEN = _among(b"abcdefghijklmnopqrstuvwxyz0123456789")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP_RUN = re.compile(rb"[ \t\n\r\f]+")

_U = np.uint64


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string array; a null counts as empty."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets or bytes(8), np.int64 if pa.types.is_large_string(texts.type) else np.int32)
    bounds = bounds[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data or b"", np.uint8), bounds


def slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and bounds of some rows at a time."""
    data, bounds = text_bytes(texts)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(bounds, bounds[row] + SLICE_BYTES, "right")) - 1
        end = min(max(end, row + 1), len(texts))
        yield row, data[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row]
        row = end


def paired_slices(a: pa.Array, b: pa.Array) -> Iterator[tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]]:
    """Bytes and bounds of the same rows of two string arrays, some rows at a time."""
    sides = [text_bytes(x) for x in (a, b)]
    both = sides[0][1] + sides[1][1]
    row = 0
    while row < len(a):
        end = int(np.searchsorted(both, both[row] + SLICE_BYTES, "right")) - 1
        end = min(max(end, row + 1), len(a))
        yield tuple((data[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row]) for data, bounds in sides)
        row = end


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each value (0 or more) among the distinct ones, and where each of these occurs first."""
    shift = len(values).bit_length()
    if int(values.max(initial=0)).bit_length() + shift > 62:
        _, first, place = np.unique(values, return_index=True, return_inverse=True)
        return place, first
    # Sorting numbers that hold value and position is faster than sorting positions by value.
    both = np.sort(values << shift | np.arange(len(values)))
    value, at = both >> shift, both & ((1 << shift) - 1)
    new = np.diff(value, prepend=-1) > 0
    place = np.empty(len(values), np.int64)
    place[at] = np.cumsum(new) - 1
    return place, at[new]


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values (0 or more), in order."""
    found = np.sort(values)
    return found[np.diff(found, prepend=-1) > 0]


class Tokens(NamedTuple):
    """The tokens of some texts."""

    starts: np.ndarray  # where each token begins in the bytes
    codes: np.ndarray  # its place among the distinct ones
    words: pa.Array  # the distinct ones


def tokens_of(data: np.ndarray, bounds: np.ndarray) -> Tokens:
    """Lower-case runs of ``a-z0-9``; none crosses a bound."""
    low = _LOWER[data]
    inside = _IN_TOKEN[low]
    shown = inside
    # Two other letters have an ASCII one in their lower case: the Kelvin sign, and the I with a dot, which goes on with a mark.
    kelvin = np.flatnonzero(data[:-2] == 0xE2)
    kelvin = kelvin[(data[kelvin + 1] == 0x84) & (data[kelvin + 2] == 0xAA)]
    dotted = np.flatnonzero(data[:-1] == 0xC4)
    dotted = dotted[data[dotted + 1] == 0xB0]
    if len(kelvin) or len(dotted):
        low[kelvin], low[dotted] = ord("k"), ord("i")
        inside[kelvin] = inside[dotted] = True
        shown = inside.copy()
        inside[kelvin + 1] = inside[kelvin + 2] = True
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[inner] = inside[inner]
    starts = np.flatnonzero(begins)
    so_far = np.concatenate([[0], np.cumsum(shown)])
    offsets = np.concatenate([so_far[starts], so_far[-1:]]).astype(np.int32)
    found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(low[shown])).dictionary_encode()
    return Tokens(starts, found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary)


class Parts(NamedTuple):
    """The sentences of some texts, and the tokens in them."""

    data: np.ndarray  # the bytes of all texts
    first: np.ndarray  # the first sentence of each text, and the end
    starts: np.ndarray  # where each sentence begins in data
    ends: np.ndarray
    n_words: np.ndarray  # of each sentence
    first_token: np.ndarray  # of each sentence, and the end
    tokens: Tokens

    def nested(self, codes: np.ndarray, first_token: np.ndarray) -> pa.Array:
        """For each text the words with these codes of every sentence."""
        words = pa.DictionaryArray.from_arrays(pa.array(codes, pa.int32()), self.tokens.words)
        sents = pa.ListArray.from_arrays(pa.array(first_token, pa.int32()), words)
        return pa.ListArray.from_arrays(pa.array(self.first, pa.int32()), sents)


def _stripped(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges without surrounding spaces, where anything is left."""
    solid = np.flatnonzero(~_SPACE[data])
    left, right = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    some = left < right
    starts, ends = solid[left[some]], solid[right[some] - 1] + 1
    wide = np.flatnonzero(_WIDE[data[starts]] | (data[ends - 1] >= 0x80))
    for i in wide.tolist():
        text = data[starts[i] : ends[i]].tobytes().decode("utf-8", "surrogateescape").lstrip()
        starts[i] = ends[i] - len(text.encode("utf-8", "surrogateescape"))
        ends[i] = starts[i] + len(text.rstrip().encode("utf-8", "surrogateescape"))
    some = starts < ends
    return starts[some], ends[some]


def parts_of(data: np.ndarray, bounds: np.ndarray) -> Parts:
    """Sentences in order: broken at newlines and after ``.``, ``!`` or ``?``."""
    gap = _GAP[data]
    cut = data == ord("\n")
    cut[1:] |= gap[1:] & _MARK[data[:-1]]
    cuts = np.flatnonzero(cut)
    # Sorted, the beginnings and the ends are those of the same pieces.
    begin = np.sort(np.concatenate([bounds[:-1], cuts + 1]))
    end = np.sort(np.concatenate([cuts, bounds[1:]]))
    starts, ends = _stripped(data, begin, end)
    first = np.searchsorted(starts, bounds)
    gap[1:] &= ~gap[:-1]
    gaps = np.concatenate([[0], np.cumsum(gap)])
    tokens = tokens_of(data, bounds)
    first_token = np.append(np.searchsorted(tokens.starts, starts), len(tokens.starts))
    return Parts(data, first, starts, ends, gaps[ends] - gaps[starts] + 1, first_token, tokens)


def choose(parts: Parts, scores: np.ndarray, budgets: list[int | None], no_repeat: int) -> list[bytes]:
    """For each text the sentences that ``choose_sentences`` keeps, best scores first, of equals the earlier."""
    text_of = np.repeat(np.arange(len(parts.first) - 1), np.diff(parts.first))
    ranked = np.lexsort((-scores, text_of))
    sizes, ranked, first = parts.n_words[ranked].tolist(), ranked.tolist(), parts.first.tolist()
    starts, ends, first_token = parts.starts.tolist(), parts.ends.tolist(), parts.first_token.tolist()
    raw, codes = parts.data.tobytes(), parts.tokens.codes
    out = []
    for t, budget in enumerate(budgets):
        kept: list[tuple[int, bytes]] = []
        grams: set[tuple[int, ...]] = set()
        left = -1 if budget is None else budget
        if budget is not None and budget < 0:
            raise ValueError("a summary has no negative number of words")
        for i in range(first[t], first[t + 1]):
            size = sizes[i]
            if min(size, budget or 0) > left or left < 0:
                continue
            s = ranked[i]
            text, end = raw[starts[s] : ends[s]], first_token[s + 1]
            if size > budget:
                text, end = b" ".join(_GAP_RUN.split(text)[:budget]), first_token[s] + _tokens_within(parts, s, budget)
            own = codes[first_token[s] : end].tolist()
            new = set(zip(*(own[k:] for k in range(no_repeat)), strict=False))
            if grams.isdisjoint(new):
                kept.append((s, text))
                grams |= new
                left -= min(size, budget)
                if not left and budget:
                    break
        out.append(b" ".join(text for _, text in sorted(kept)))
    return out


def _tokens_within(parts: Parts, s: int, n_words: int) -> int:
    """How many tokens the first ``n_words`` words of a longer sentence have."""
    text = parts.data[parts.starts[s] : parts.ends[s]].tobytes()
    end = 0
    for k, found in enumerate(_GAP_RUN.finditer(text), 1):
        if k == n_words:
            end = found.start()
            break
    return int(np.searchsorted(parts.tokens.starts, parts.starts[s] + end) - parts.first_token[s])


def _mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes a step."""
    data, bounds = text_bytes(words)
    data = data[: bounds[-1]]
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    sizes = np.diff(bounds)
    out = _mix((sizes.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15))
    at, done = np.flatnonzero(sizes > 0), 0
    while len(at):
        left = np.minimum(sizes[at] - done, 8)
        chunk = eight[bounds[at] + done] & (_U(0xFFFFFFFFFFFFFFFF) >> ((8 - left) * 8).astype(_U))
        out[at] = _mix((out[at] ^ chunk) * _U(0x9E3779B97F4A7C15))
        done += 8
        at = at[sizes[at] > done]
    return out
