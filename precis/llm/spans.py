"""Repeated runs of sentences across documents.

A sentence ends with a word that ends in ``.``, ``!`` or ``?``, before a newline, or
with the text. From each sentence on, and back from each, the shortest run of at
least ``min_sentences`` sentences and ``min_words`` words is hashed (a sentence of
``long_sentence`` words is a run by itself), so that of any longer repeated passage
every sentence lies in such a run inside it. Runs compare by their words with A-Z
lowered, whatever white space stands between them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.llm.words import Range, Slice, mapped, slices
from precis.session import stage_table

MIN_SENTENCES = 2
MIN_WORDS = 20
LONG_SENTENCE = 50

_STOPS = np.zeros(256, dtype=bool)
_STOPS[[ord(c) for c in ".!?"]] = True


def sentences(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end word and row of every sentence of a slice."""
    n = len(part.starts)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    last = _STOPS[part.data[part.ends - 1]]
    lines = np.concatenate([[0], np.cumsum(part.data == 10)])
    last[:-1] |= lines[part.starts[1:]] > lines[part.ends[:-1]]
    ends = part.first[1:]
    last[ends[ends > 0] - 1] = True
    stop = np.flatnonzero(last) + 1
    begin = np.concatenate([[0], stop[:-1]])
    return begin, stop, np.searchsorted(part.first, begin, "right") - 1


def runs(
    begin: np.ndarray, stop: np.ndarray, row: np.ndarray, min_sentences: int, min_words: int, long_sentence: int
) -> tuple[np.ndarray, np.ndarray]:
    """First and last sentence of every run, forward and backward, each once."""
    n = len(begin)
    i = np.arange(n)
    alone = stop - begin >= long_sentence
    last = np.maximum(np.searchsorted(stop, begin + min_words), i + min_sentences - 1)
    last = np.where(alone, i, last)
    first = np.minimum(np.searchsorted(begin, stop - min_words, "right") - 1, i - min_sentences + 1)
    first = np.where(alone, i, first)
    a, b = np.concatenate([i, first]), np.concatenate([last, i])
    inside = (a >= 0) & (b < n)
    a, b = a[inside], b[inside]
    inside = row[a] == row[b]
    code = np.unique(a[inside] * n + b[inside])
    return code // max(n, 1), code % max(n, 1)


def _hashed(rows: DataFrame, min_sentences: int, min_words: int, long_sentence: int) -> DataFrame:
    """``(h, key, doc, first, last)`` of every run of ``(key, doc, text)``."""

    def hashed(batch):
        for part in slices(batch.column(2)):
            begin, stop, row = sentences(part)
            a, b = runs(begin, stop, row, min_sentences, min_words, long_sentence)
            hashes = Range(part.hashes).hash(begin[a], stop[b])
            opening = np.searchsorted(row, row[a])  # the first sentence of the row
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes.view(np.int64)),
                    batch.column(0).take(pa.array(part.row + row[a])),
                    batch.column(1).take(pa.array(part.row + row[a])),
                    pa.array((a - opening).astype(np.int32)),
                    pa.array((b - opening).astype(np.int32)),
                ],
                names=["h", "key", "doc", "first", "last"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    return mapped(rows, hashed, f"h long, key {kind}, doc long, first int, last int")


def _cut(part: Slice, rows: pa.RecordBatch) -> Iterator[tuple[str, int, int]]:
    """(text, sentences, removed sentences) of each row of a slice."""
    begin, stop, row = sentences(part)
    opening = np.searchsorted(row, np.arange(len(part.bounds)))
    for r in range(len(part.bounds) - 1):
        a, b = int(opening[r]), int(opening[r + 1])
        text = part.data[part.bounds[r] : part.bounds[r + 1]].tobytes()
        firsts = rows.column(2)[part.row + r].as_py() or []
        gone = np.zeros(b - a, dtype=bool)
        for first, last in zip(firsts, rows.column(3)[part.row + r].as_py() or [], strict=True):
            gone[first : last + 1] = True
        if gone.any():
            edges = np.append(part.starts[begin[a:b]], part.bounds[r + 1]) - part.bounds[r]
            kept = [text[edges[s] : edges[s + 1]] for s in np.flatnonzero(~gone)]
            text = text[: edges[0]] + b"".join(kept)
        yield text.decode(), b - a, int(gone.sum())


def without_repeats(
    df: DataFrame,
    key: str,
    text: str,
    min_sentences: int = MIN_SENTENCES,
    min_words: int = MIN_WORDS,
    long_sentence: int = LONG_SENTENCE,
) -> DataFrame:
    """``(key, text, n_sentences, n_removed)``: texts without the sentences of any repeated run but the first.

    The first is the one of the smallest (key, hash of the text, place). A sentence goes
    with the white space behind it; what stands before the first sentence stays. Runs
    are written once and joined on their hash, the owner of a hash being found by a
    minimum, so a passage that many documents share is never gathered. Null texts
    stay null with no sentences; rows with a null key stay as they are and own nothing.
    Rows are told apart by key and text: different texts under one key are documents of
    their own, each cut by its own repeats, and rows that repeat key and text are one
    document and stay alike. Whole texts are read; an empty table gives no rows.
    """
    rows = df.select(F.col(key).alias("key"), F.xxhash64(text).alias("doc"), F.col(text).alias("text"))
    own = rows.where(F.col("key").isNotNull())
    found = stage_table(_hashed(own, min_sentences, min_words, long_sentence), "runs")
    owner = found.groupBy("h").agg(F.min(F.struct("key", "doc", "first")).alias("owner"), F.count(F.lit(1)).alias("n"))
    owner = owner.where("n > 1").select("h", "owner")
    # A table of its own, so that the join can split a hash that very many runs have.
    owner = stage_table(owner, "owners")
    repeats = found.join(owner, "h").where("key != owner.key or doc != owner.doc or first != owner.first")
    gone = repeats.groupBy("key", "doc").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("gone"))
    marked = rows.join(gone, ["key", "doc"], "left").select(
        "key", "text", F.col("gone.first").alias("firsts"), F.col("gone.last").alias("lasts")
    )

    def cut(batch):
        done = [x for part in slices(batch.column(1)) for x in _cut(part, batch)]
        texts = pa.array([x[0] for x in done], pa.string())
        null = pa.array(np.asarray(batch.column(1).is_null()))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.compute.if_else(null, pa.scalar(None, pa.string()), texts),
                pa.array([x[1] for x in done], pa.int32()),
                pa.array([x[2] for x in done], pa.int32()),
            ],
            names=["key", "text", "n_sentences", "n_removed"],
        )

    kind = rows.schema["key"].dataType.simpleString()
    return mapped(marked, cut, f"key {kind}, text string, n_sentences int, n_removed int")
