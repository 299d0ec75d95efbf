"""Longest common subsequences of token lists, for use inside Arrow batches."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence


def lcs_length(a: Sequence[str], b: Sequence[str]) -> int:
    """Length of the longest common subsequence (bit-parallel, Hyyrö 2004)."""
    places: dict[str, int] = {}
    for i, t in enumerate(a):
        places[t] = places.get(t, 0) | (1 << i)
    full = (1 << len(a)) - 1
    open_ = full
    for t in b:
        hit = open_ & places.get(t, 0)
        if hit:
            open_ = ((open_ + hit) | (open_ - hit)) & full
    return len(a) - open_.bit_count()


def lcs_places(ref: Sequence[str], cand: Sequence[str]) -> set[int]:
    """Positions in ``ref`` of one longest common subsequence.

    Walking back, a tie moves along ``ref``. For each token of ``ref`` one integer
    has a bit for each place of ``cand`` at which the length does not grow; the
    walk back needs only two neighbouring lengths, which one bit tells apart.
    """
    places: dict[str, int] = {}
    for j, t in enumerate(cand):
        places[t] = places.get(t, 0) | (1 << j)
    full = (1 << len(cand)) - 1
    rows, flat = [full], full
    for t in ref:
        hit = flat & places.get(t, 0)
        flat = ((flat + hit) | (flat - hit)) & full
        rows.append(flat)
    i, j, out = len(ref), len(cand), set()
    # The length of (i, j - 1) less that of (i - 1, j), kept while walking.
    above = (rows[i - 1] ^ full).bit_count() if i else 0
    here = (rows[i] ^ full).bit_count()
    while i and j:
        left = here - (not rows[i] >> (j - 1) & 1)
        if ref[i - 1] == cand[j - 1]:
            corner = above - (not rows[i - 1] >> (j - 1) & 1)
            i, j, here = i - 1, j - 1, corner
            out.add(i)
            above = here - _step(rows, i, j, full) if i else 0
        elif left > above:
            above -= not rows[i - 1] >> (j - 1) & 1
            j, here = j - 1, left
        else:
            i, here = i - 1, above
            above = here - _step(rows, i, j, full) if i else 0
    return out


def _step(rows: Sequence[int], i: int, j: int, full: int) -> int:
    """By how much the length grows from row ``i - 1`` to row ``i`` at column ``j``."""
    low = (1 << j) - 1
    return ((rows[i] ^ full) & low).bit_count() - ((rows[i - 1] ^ full) & low).bit_count()


def union_hits(ref: Sequence[Sequence[str]], cand: Sequence[Sequence[str]]) -> int:
    """Tokens of the union LCS over all sentence pairs, each counted at most as often as on either side."""
    left_r = Counter(t for s in ref for t in s)
    left_c = Counter(t for s in cand for t in s)
    hits = 0
    for r in ref:
        found = set().union(*(lcs_places(r, c) for c in cand))
        for i in sorted(found):
            t = r[i]
            if left_r[t] > 0 and left_c[t] > 0:
                left_r[t] -= 1
                left_c[t] -= 1
                hits += 1
    return hits
