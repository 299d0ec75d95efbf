"""Language identification by cross-parsing entropy.

For each language a suffix automaton of a sample of its labelled text is built. A
text is parsed against each automaton into phrases, each the longest match of what
remains with any substring of the sample. A sample of n characters needs about
log2(n) bits to point at a phrase, so phrases times log2(n) over the text's length
is its entropy in that language; the lowest wins.

Automata become plain transition tables in which a failed match leads on from the
start state, so that many texts are parsed side by side, one character a step.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precis.llm.words import buffers, mapped

# Bounds of the fit: documents of each language and characters of each document.
SAMPLE_DOCUMENTS = 64
SAMPLE_CHARS = 400
MAX_LANGUAGES = 256
# A phrase also ends after so many characters, which bounds the steps of a parse.
LANE_CHARS = 4096
_LANES = 4096
UNKNOWN = "und"

_SPACE = 1  # code of any run of characters that are no letters; 0 is a letter of no sample
_POINTS = 0x110000


def _fold(text: str) -> str:
    """Lower-cased letters; anything else is a space, a run of them one."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


class Automaton:
    """Suffix automaton of one text."""

    def __init__(self, text: str):
        self.next: list[dict[str, int]] = [{}]
        length, link, last = [0], [-1], 0
        for c in text:
            new = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = link[p]
            if p >= 0:
                q = self.next[p][c]
                if length[q] != length[p] + 1:
                    copy = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = copy
                        p = link[p]
                    link[q] = copy
                    q = copy
                link[new] = q
            last = new


class Tables(NamedTuple):
    """All automata, one after another, as one transition table."""

    names: list[str]
    bits: np.ndarray  # per phrase of each language
    codes: np.ndarray  # code of every code point
    step: np.ndarray  # 4 * next state + phrases ended, at state * letters + code
    start: np.ndarray  # start state of each language
    letters: int


def build(samples: dict[str, str]) -> Tables:
    """Tables of the languages' samples."""
    folded = {name: _fold(text) for name, text in sorted(samples.items())}
    alphabet = sorted(set("".join(folded.values())) - {" "})
    code = {" ": _SPACE} | {c: i + 2 for i, c in enumerate(alphabet)}
    codes = np.full(_POINTS, _SPACE, dtype=np.uint16)
    for point in range(_POINTS):
        if 0xD800 <= point < 0xE000:
            continue
        c = chr(point)
        if c.isalpha():
            codes[point] = code.get(c.lower(), 0)
    letters, rows, starts = len(code) + 1, [], []
    at = 0
    for text in folded.values():
        own = Automaton(text + " ").next
        starts.append(at)
        table = np.full((len(own), letters), -1, dtype=np.int64)
        for state, moves in enumerate(own):
            for c, to in moves.items():
                table[state, code[c]] = to
        # A failed match ends a phrase; a character that no phrase begins with is one more.
        strange = table[0] < 0
        again = 4 * (np.where(strange, 0, table[0]) + at) + 1 + strange
        moves = np.where(table >= 0, 4 * (table + at), again[None, :])
        moves[0] = np.where(strange, 4 * at + 1, moves[0])
        rows.append(moves.astype(np.int32))
        at += len(own)
    bits = np.log2([max(2, len(t)) for t in folded.values()])
    step = np.concatenate(rows) if rows else np.zeros((0, letters), np.int32)
    return Tables(list(folded), bits, codes, step.ravel(), np.array(starts, dtype=np.int64), letters)


def _lanes(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, length and row of the pieces of at most LANE_CHARS that texts are parsed in, longest first."""
    sizes = np.diff(bounds)
    pieces = -(-sizes // LANE_CHARS)
    row = np.repeat(np.arange(len(sizes)), pieces)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = bounds[row] + inner * LANE_CHARS
    length = np.minimum(LANE_CHARS, bounds[row + 1] - begin)
    order = np.argsort(-length, kind="stable")
    return begin[order], length[order], row[order]


def _phrases(tables: Tables, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Phrases of each row (texts are ``codes[bounds[i] : bounds[i + 1]]``) in each language."""
    out = np.zeros((len(bounds) - 1, len(tables.names)), dtype=np.int64)
    begins, lengths, rows = _lanes(codes, bounds)
    for at in range(0, len(begins), _LANES):
        begin, length, row = (x[at : at + _LANES] for x in (begins, lengths, rows))
        state = np.repeat(tables.start[:, None], len(begin), axis=1)
        ended = np.zeros(state.shape, dtype=np.int64)
        steps = int(length[0]) if len(length) else 0
        active = np.searchsorted(-length, -np.arange(steps), "left")  # lanes longer than the step
        for t in range(steps):
            n = int(active[t])
            move = tables.step[state[:, :n] * tables.letters + codes[begin[:n] + t]]
            ended[:, :n] += move & 3
            state[:, :n] = move >> 2
        np.add.at(out, row, (ended + (state != tables.start[:, None])).T)
    return out


_built: dict[str, Tables] = {}


def _tables(samples: dict[str, str], name: str) -> Tables:
    if name not in _built:
        _built.clear()
        _built[name] = build(samples)
    return _built[name]


def _judge(tables: Tables, texts: pa.Array) -> tuple[list[str], list[float], list[float]]:
    data, bounds = buffers(texts)
    data, bounds = data[bounds[0] : bounds[-1]], bounds - bounds[0]
    # Code points begin at bytes other than 10xxxxxx.
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
    codes, own = tables.codes[points], leads[bounds]
    # Runs of spaces count once, none at the beginning of a text.
    first = np.zeros(len(codes), dtype=bool)
    first[own[:-1][own[:-1] < len(codes)]] = True
    keep = codes != _SPACE
    keep[1:] |= (codes[:-1] != _SPACE) & ~first[1:]
    letters = np.concatenate([[0], np.cumsum(codes != _SPACE)])
    kept = np.concatenate([[0], np.cumsum(keep)])
    codes, bounds = codes[keep].astype(np.int64), kept[own]
    has = letters[own[1:]] > letters[own[:-1]]
    if not tables.names:
        return [UNKNOWN] * len(has), [0.0] * len(has), [0.0] * len(has)
    phrases = _phrases(tables, codes, bounds)
    entropy = phrases * tables.bits / np.maximum(1, np.diff(bounds))[:, None]
    order = np.argsort(entropy, axis=1, kind="stable")
    best = np.take_along_axis(entropy, order[:, :1], 1)[:, 0]
    if len(tables.names) > 1:
        second = np.take_along_axis(entropy, order[:, 1:2], 1)[:, 0]
        score = second / np.maximum(best + second, 1e-300)
    else:
        score = np.ones(len(best))
    names = [tables.names[i] if ok else UNKNOWN for i, ok in zip(order[:, 0], has, strict=True)]
    return names, np.where(has, score, 0.0).tolist(), np.where(has, best, 0.0).tolist()


def samples(
    df: DataFrame,
    key: str,
    text: str,
    lang: str,
    learns: Column,
    documents: int = SAMPLE_DOCUMENTS,
    chars: int = SAMPLE_CHARS,
) -> dict[str, str]:
    """A text of each language from the ``documents`` labelled ones with the lowest hash of their key.

    Each gives ``chars`` characters from its middle. Rows whose text, label or key is
    null, or with ``learns`` not true, are not sampled. The sample has a bounded
    number of rows, the only thing collected; more than 256 languages raise an error.
    """
    own = df.where(learns & F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(key).isNotNull())
    own = own.where(F.col(text).rlike(r"\p{L}"))
    size = F.length(F.col(text))
    begin = F.greatest(F.lit(1), F.floor(size / 2).cast("int") - chars // 2)
    own = own.select(
        F.col(lang).alias("lang"),
        F.struct(F.xxhash64(key).alias("h"), F.col(text).substr(begin, F.lit(chars)).alias("text")).alias("one"),
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("one"))
    chosen = own.withColumn("rank", rank).where(F.col("rank") <= documents)
    out: dict[str, list] = {}
    rows = chosen.select("lang", "one").limit(documents * MAX_LANGUAGES + 1).collect()
    if len(rows) > documents * MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages are labelled")
    for r in sorted(rows, key=lambda r: (r["lang"], r["one"]["h"], r["one"]["text"])):
        out.setdefault(r["lang"], []).append(r["one"]["text"])
    return {name: "\n".join(texts) for name, texts in out.items()}


def identify(df: DataFrame, key: str, text: str, known: dict[str, str]) -> DataFrame:
    """``(key, lang_pred, score, entropy)`` of every row's whole text against samples of languages.

    ``score`` is the second-best entropy over the sum of the two best, from 0.5 (a
    tie, which goes to the first name) up to 1; one language alone scores 1. A null
    text, one without letters, or no sample at all gives ``und`` and 0. Null and
    repeated keys are returned as they are; an empty table gives no rows.
    """
    name = hashlib.sha256(repr(sorted(known.items())).encode()).hexdigest()

    def judge(batch):
        tables = _tables(known, name)
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            names, scores, entropy = _judge(tables, part.column(1))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(names), pa.array(scores), pa.array(entropy)],
                names=["key", "lang_pred", "score", "entropy"],
            )

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return mapped(rows, judge, f"key {kind}, lang_pred string, score double, entropy double")
