"""URL rules as one bit-parallel wildcard automaton.

Rules are globs over a canonical URL, the host in lower case followed by the path:
``*`` stands for any characters but ``/``, ``**`` for any characters. Every other
character of a rule is a bit in masks of 64-bit words. Reading one character of
every URL at once shifts the sets of reached places by one, keeps those that the
character matches (Shift-And) and adds places that a wildcard holds; carries run on
from word to word. So one pass over the URLs tries all rules.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.llm.words import buffers, mapped

ALLOW, BLOCK = "allow", "block"
# URLs that are read side by side.
_LANES = 4096


class Glob(NamedTuple):
    """A rule of the automaton; of those that match a URL the highest rank decides."""

    name: str
    pattern: str
    verdict: str
    rank: int


def site_globs(rules: Sequence[tuple[str, str]]) -> list[Glob]:
    """Globs of ``(verdict, "host/path")`` rules: the host or a subdomain of it, the path or what begins with it.

    The longest such rule has the highest rank; of equal ones the first.
    """
    out = []
    for verdict, rule in rules:
        rank = len(rule)
        out += [Glob(rule, f"{rule}**", verdict, rank), Glob(rule, f"*.{rule}**", verdict, rank)]
    return out


def word_globs(words: Sequence[str], verdict: str = BLOCK) -> list[Glob]:
    """Globs that match a host with one of the words in it; below every site rule."""
    return [Glob(w, pattern, verdict, 0) for w in words for pattern in (f"*{w}*", f"*{w}*/**")]


class Automaton:
    """Masks of many globs."""

    def __init__(self, globs: Sequence[Glob]):
        places, self.final, held, opening = [], [], {}, []
        for glob in globs:
            # Place 0 of a glob stands before its first character.
            opening.append(len(places))
            places.append(None)
            data, i = glob.pattern.encode(), 0
            while i < len(data):
                if data[i : i + 2] == b"**":
                    held[len(places) - 1] = "any"
                    i += 2
                elif data[i : i + 1] == b"*":
                    held.setdefault(len(places) - 1, "part")
                    i += 1
                else:
                    places.append(data[i])
                    i += 1
            self.final.append(len(places) - 1)
        n = max(1, -(-len(places) // 64))
        self.words = n
        # Bits of the places that a byte leads to, and of those at which it stays.
        self.match = np.zeros((256, n), dtype=np.uint64)
        self.stay = np.zeros((256, n), dtype=np.uint64)
        for at, byte in enumerate(places):
            if byte is not None:
                self.match[byte, at // 64] |= np.uint64(1 << at % 64)
        for at, kind in held.items():
            bytes_ = [b for b in range(256) if kind == "any" or b != ord("/")]
            self.stay[bytes_, at // 64] |= np.uint64(1 << at % 64)
        self.opening = np.zeros(n, dtype=np.uint64)
        for at in opening:
            self.opening[at // 64] |= np.uint64(1 << at % 64)

    def run(self, data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Which globs match which byte ranges: (ranges, globs)."""
        out = np.zeros((len(begin), len(self.final)), dtype=bool)
        order = np.argsort(-length, kind="stable")
        final = np.array(self.final, dtype=np.int64)
        for at in range(0, len(order), _LANES):
            own = order[at : at + _LANES]
            start, size = begin[own], length[own]
            state = np.repeat(self.opening[None, :], len(own), axis=0)
            steps = int(size[0]) if len(size) else 0
            active = np.searchsorted(-size, -np.arange(steps), "left")
            for t in range(steps):
                n = int(active[t])
                byte, now = data[start[:n] + t], state[:n]
                carry = np.zeros_like(now)
                carry[:, 1:] = now[:, :-1] >> np.uint64(63)
                state[:n] = (((now << np.uint64(1)) | carry) & self.match[byte]) | (now & self.stay[byte])
            if len(final):
                out[own] = (state[:, final // 64] >> (final % 64).astype(np.uint64)) & np.uint64(1) != 0
        return out


def filtered(df: DataFrame, key: str, url: str, globs: Sequence[Glob], otherwise: str = ALLOW) -> DataFrame:
    """``(key, host, path, rule, verdict)`` of every URL.

    The host stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with
    A-Z lowered; the path from there up to ``?``, ``#`` or the end. Both are empty
    for null and for a text without ``://``. ``rule`` is the name of the highest
    matching glob, the first one of equals, and ``verdict`` its verdict; without one
    they are null and ``otherwise``. The rules are sent to every task; give at most
    some thousands. Null and repeated keys are returned as they are; an empty table
    gives no rows.
    """
    ranked = sorted(globs, key=lambda g: -g.rank)
    rest = F.regexp_extract(F.col(url), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    none = F.lit("")
    rows = df.select(
        F.col(key).alias("key"), F.coalesce(low, none).alias("host"), F.coalesce(path, none).alias("path")
    ).withColumn("canonical", F.concat("host", "path"))

    def judge(batch):
        automaton = Automaton(ranked)
        data, bounds = buffers(batch.column(3))
        found = automaton.run(data, bounds[:-1], np.diff(bounds))
        hit = found.any(axis=1)
        first = found.argmax(axis=1) if len(ranked) else np.zeros(len(hit), dtype=np.int64)
        names = [ranked[i].name if h else None for i, h in zip(first, hit, strict=True)]
        kinds = [ranked[i].verdict if h else otherwise for i, h in zip(first, hit, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(names, pa.string()), pa.array(kinds, pa.string())],
            names=["key", "host", "path", "rule", "verdict"],
        )

    kind = rows.schema["key"].dataType.simpleString()
    return mapped(rows, judge, f"key {kind}, host string, path string, rule string, verdict string")
