"""Importance resampling towards a target: documents whose words look like the target's are drawn more often.

Each run of 1 to ``runs`` words is a feature and falls by its crc32 into one of
``buckets``. Counts of the buckets over all documents and over the target give an
array of gains, a document's weight is the mean gain of its features, and a Gumbel
variate from the document's key turns the highest scores into a draw without
replacement. The cutoff is found by weighted median-of-medians selection: every task
gives the median of its remaining rows, the median of these, weighted by how many rows
each stands for, splits what remains, and at least a quarter goes in each round,
however the rows lie. Only the winners are sorted.
"""

from __future__ import annotations

import math
import zlib
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.llm.words import SLICE_BYTES, buffers, mapped, spans
from precis.operators.skew import with_positions
from precis.session import ship_package, stage_table

# Longer words are hashed one by one.
_LONG_WORD = 64
# What remains is written anew once it is less than this part of the table it is read from.
_SHRINK = 0.25
_ORDER = ("_high", "_unnamed", "key", "n_features", "weight")


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)  # fixed value: crc32's polynomial
    return table


_CRC = _crc_table()
_WORD_BYTES = np.zeros(256, dtype=bool)
_WORD_BYTES[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20


def crc32s(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """crc32 of each range of bytes, carried on from the values ``before`` if given."""
    out = np.zeros(len(starts), np.uint32) if before is None else before.astype(np.uint32)
    sizes = ends - starts
    for i in np.flatnonzero(sizes > _LONG_WORD):
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(out[i]))
    order = np.flatnonzero(sizes <= _LONG_WORD)
    order = order[np.argsort(-sizes[order], kind="stable")]
    state, place = ~out[order], starts[order]
    longer = np.searchsorted(-sizes[order], -np.arange(_LONG_WORD + 1), "left")  # how many have over j bytes
    for j in range(_LONG_WORD):
        n = longer[j]
        if not n:
            break
        now = state[:n]
        state[:n] = _CRC[(now ^ data[place[:n] + j]) & 0xFF] ^ (now >> 8)
    out[order] = ~state
    return out


def _features(texts: pa.Array, buckets: int, runs: int):
    """``(first row, first word of each text, first feature of each text, buckets of the features)`` by slices."""
    data, bounds = buffers(texts)
    row = 0
    while row < len(bounds) - 1:
        end = int(np.searchsorted(bounds, bounds[row] + SLICE_BYTES, "right")) - 1
        end = min(max(end, row + 1), len(bounds) - 1)
        own = bounds[row : end + 1] - bounds[row]
        part = _FOLD[data[bounds[row] : bounds[end]]]
        starts, ends = spans(part, own, _WORD_BYTES)
        words = np.searchsorted(starts, own)
        of = np.repeat(np.arange(len(words) - 1), np.diff(words))
        hashes = crc32s(part, starts, ends)
        found, owners = [hashes % buckets], [of]
        for n in range(1, runs):
            hashes = hashes[:-1]
            spaced = _CRC[(~hashes ^ 0x20) & 0xFF] ^ (~hashes >> 8)
            hashes = crc32s(part, starts[n:], ends[n:], ~spaced)
            inside = of[n:] == of[:-n]
            found.append(hashes[inside] % buckets)
            owners.append(of[n:][inside])
        features, owner = np.concatenate(found), np.concatenate(owners)
        if runs > 1:
            features = features[np.argsort(owner, kind="stable")]
        sizes = np.bincount(owner, minlength=len(own) - 1)
        yield row, words, np.concatenate([[0], np.cumsum(sizes)]), features
        row = end


def bucket_counts(df: DataFrame, text: str, buckets: int, runs: int = 1) -> np.ndarray:
    """Features of all rows by bucket; each task adds its own up first, so at most ``buckets`` numbers leave it."""
    ship_package(df.sparkSession)

    def count(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for *_, features in _features(batch.column(0), buckets, runs):
                total += np.bincount(features, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    counted = df.select(F.col(text).alias("text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log of how much more frequent each bucket is in the target, plus one each, rounded down."""
    n, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    ratios = (
        float(t + 1) * float(s_all + n) / (float(s + 1) * float(t_all + n))
        for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
    )
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64)


def weights(
    df: DataFrame, key: str, text: str, target: DataFrame, target_text: str, buckets: int = 10_000, runs: int = 1
) -> DataFrame:
    """``(key, n_words, n_features, weight)``: the mean gain of each row's features, rounded down (none: 0)."""
    corpus = bucket_counts(df, text, buckets, runs)
    gain = gains(corpus, bucket_counts(target, target_text, buckets, runs))
    kind = df.schema[key].dataType.simpleString()

    def weigh(batch):
        columns = [np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3)]
        for row, words, first, features in _features(batch.column(1), buckets, runs):
            sums = np.concatenate([[0], np.cumsum(gain[features])])
            here = slice(row, row + len(first) - 1)
            columns[0][here] = np.diff(words)
            columns[1][here] = np.diff(first)
            columns[2][here] = np.diff(sums[first]) // np.maximum(np.diff(first), 1)
        arrays = [batch.column(0), *map(pa.array, columns)]
        yield pa.RecordBatch.from_arrays(arrays, names=["key", "n_words", "n_features", "weight"])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return mapped(rows, weigh, f"key {kind}, n_words long, n_features long, weight long")


def noise(key: str, seed: int) -> Column:
    """1000 times a Gumbel variate, rounded down, from the first 32 bits of sha256 of ``seed:key``."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


class _Split(NamedTuple):
    """Of some rows: how many, and the medians of parts of them with the parts' sizes."""

    n: int
    medians: list[tuple[tuple, int]]

    def pivot(self) -> tuple:
        """The weighted median of the medians."""
        seen = 0
        for median, size in sorted(self.medians):
            seen += size
            if 2 * seen >= self.n:
                return median
        raise ValueError("no rows")


def _order(df: DataFrame) -> DataFrame:
    return df.withColumns({"_high": -F.col("score"), "_unnamed": F.col("key").isNull()})


def _place() -> Column:
    return F.struct(*_ORDER)


def _at(df: DataFrame, values: tuple) -> Column:
    return F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(_ORDER, values, strict=True)])


def _splits(df: DataFrame, side: Column) -> dict[int, _Split]:
    """For each value of ``side`` the rows and the medians of each task's rows, one short row a task and side."""
    fields = {c: df.schema[c].dataType.simpleString() for c in _ORDER}
    schema = "side int, n long, " + ", ".join(f"{c} {kind}" for c, kind in fields.items())

    def medians(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        for part in table.column("side").unique().to_pylist():
            rows = table.filter(pc.equal(table.column("side"), part)).select(list(_ORDER))
            rows = rows.sort_by([(c, "ascending") for c in _ORDER])
            found: dict[str, Any] = rows.slice((rows.num_rows - 1) // 2, 1).to_pylist()[0]
            yield pa.RecordBatch.from_pylist(
                [{"side": part, "n": rows.num_rows, **found}],
                schema=pa.schema([("side", pa.int32()), ("n", pa.int64()), *[rows.schema.field(c) for c in _ORDER]]),
            )

    got: dict[int, _Split] = {}
    for r in df.select(side.cast("int").alias("side"), *_ORDER).mapInArrow(medians, schema).collect():
        n, found = got.get(r["side"], _Split(0, []))
        got[r["side"]] = _Split(n + r["n"], [*found, (tuple(r)[2:], r["n"])])
    return got


def cutoff(df: DataFrame, n: int) -> tuple | None:
    """The place of the ``n``-th of all rows of ``df``, a table with the columns of ``_ORDER``; None for ``n`` = 0.

    The driver gets one short row from each task; a task sorts the places of its part of the table.
    """
    if n < 1:
        return None
    ship_package(df.sparkSession)
    now, size = df.select(*_ORDER), 0
    inside: Column = F.lit(True)
    remaining = _splits(now, F.lit(0)).get(0, _Split(0, []))
    size = remaining.n
    if n > size:
        raise ValueError(f"{n} of {size} rows")
    while True:
        pivot = remaining.pivot()
        at = _at(now, pivot)
        side = F.when(_place() < at, -1).when(_place() == at, 0).otherwise(1)
        got = _splits(now.where(inside), side)
        above, level = (got[s].n if s in got else 0 for s in (-1, 0))
        if above < n <= above + level:
            return pivot
        if n <= above:
            remaining, inside = got[-1], inside & (_place() < at)
        else:
            remaining, inside = got[1], inside & (_place() > at)
            n -= above + level
        if remaining.n < _SHRINK * size:
            now, size, inside = stage_table(now.where(inside), "remaining"), remaining.n, F.lit(True)


def drawn(scored: DataFrame, eligible: Column, percent: int) -> DataFrame:
    """``scored`` with ``rank`` from 1 for the highest ``percent`` of 100 eligible rows (rounded down), else null.

    ``scored`` is a staged table of ``key, n_features, weight, score`` and more. Ties go to
    the smaller key, null keys last, then to fewer features and a lower weight; rows equal
    in all of these take the last ranks in any order.
    """
    rows = _order(scored)
    chosen = rows.where(eligible)
    n = chosen.count() * percent // 100
    last = cutoff(chosen, n)
    if last is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    at = _at(rows, last)
    high = F.coalesce(eligible, F.lit(False)) & (_place() <= at)
    winners = with_positions(rows.where(high), _ORDER)
    rank = F.when(F.col("pos") < n, F.col("pos") + 1).cast("long")
    rest = rows.where(~high).withColumn("rank", F.lit(None).cast("long"))
    return winners.withColumn("rank", rank).select(*scored.columns, "rank").unionByName(rest.select(*scored.columns, "rank"))


def resample(
    df: DataFrame,
    key: str,
    text: str,
    target: DataFrame,
    target_text: str,
    percent: int = 10,
    min_words: int = 20,
    buckets: int = 10_000,
    runs: int = 1,
    seed: int = 2024,
) -> DataFrame:
    """``(key, n_features, weight, score, rank)`` of every row of ``df``; ``rank`` is null where it isn't drawn.

    Words are runs of 0-9, letters and all beyond ASCII, with A-Z folded. A null or empty
    text has no feature and weight 0, and with ``min_words`` above 0 is never drawn. Rows
    of one key get the same variate; each is drawn or not by itself. Null keys count as an
    empty name and come last among equal scores. An empty table or target is no error, and
    other columns of ``df`` and ``target`` don't matter. Texts are read twice and never
    shuffled; only the buckets' counts and one row a task reach the driver.
    """
    weighed = weights(df, key, text, target, target_text, buckets, runs)
    scored = stage_table(weighed.withColumn("score", F.col("weight") + noise("key", seed)), "scored")
    found = drawn(scored, F.col("n_words") >= min_words, percent)
    return found.select("key", "n_features", "weight", "score", "rank")
