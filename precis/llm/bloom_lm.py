"""A bigram language model in a log-frequency Bloom filter.

Counts of words and word pairs are rounded down to levels on a logarithmic scale. An
n-gram of level k is put into the filter k times, together with 1 to k; its level is
read back by asking for 1, 2, 3 and so on until the filter says no. The filter may
say yes in error, never no, so a level is never too low. It is cut into regions by
hash, each built by one task and sized by what it holds. A filter within
``FILTER_BYTES`` is broadcast; of a larger one each region stays with its shard, and
the distinct n-grams of blocks of texts are sent there to be read. Both ways give
the same levels, and all n-grams are in the filter at any size.

A token's probability follows Dirichlet smoothing: the pair's count plus ``PRIOR``
times the word's own smoothed share, over the context's count plus ``PRIOR``.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.llm.words import Slice, mapped, mix, slices, small_batches
from precis.session import ship_package, stage_table

WORD, PAIR = 0, 1
LEVEL_BASE = 1.5
PRIOR = 2000.0
BITS_PER_ENTRY = 7
BITS_SET = 3
# Bound of what is broadcast. Of a larger filter ``score`` reads the regions by shard.
FILTER_BYTES = 96 << 20
# Words whose exact counts are broadcast for the base score; others are joined.
HEAD_ROWS = 500_000
# Tokens that a task counts before it passes the counts on.
FLUSH_TOKENS = 1_000_000

_U = np.uint64
_END = _U(0x6A09E667F3BCC909)  # the token that ends a text
_CONTEXT = _U(0xBB67AE8584CAA73B)


def _bounds() -> np.ndarray:
    """The smallest count of each level."""
    return np.unique(np.ceil(LEVEL_BASE ** np.arange(0, 106))).astype(np.float64)


_LOWEST = _bounds()
_TYPICAL = np.concatenate([[0.0], np.sqrt(_LOWEST[:-1] * (_LOWEST[1:] - 1)), _LOWEST[-1:]])


def level(counts: np.ndarray) -> np.ndarray:
    """Level of each count; 0 for 0."""
    return np.searchsorted(_LOWEST, counts, "right")


def tokens(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the tokens of a slice, each text closed by its end; of their pairs with the token before; where each text begins."""
    rows = len(part.bounds) - 1
    row = np.repeat(np.arange(rows), np.diff(part.first))
    out = np.full(len(part.hashes) + rows, _END, dtype=_U)
    out[np.arange(len(row)) + row] = part.hashes
    return out, _pairs(out), part.first[:-1] + np.arange(rows)


def _pairs(own: np.ndarray) -> np.ndarray:
    """Hashes of the pairs of tokens with the one before, the first with an end."""
    before = np.empty_like(own)
    before[:1], before[1:] = _END, own[:-1]
    return mix(before * _CONTEXT + own)


def _pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys and their counts: differences by byte planes, most of which are zero, compressed."""
    steps = np.diff(keys, prepend=_U(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    planes = counts.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate([steps, planes]).tobytes())


def _unpack(payload: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8).reshape(16, n)
    both = [np.ascontiguousarray(planes[i : i + 8].T).view("<u8").ravel() for i in (0, 8)]
    return np.cumsum(both[0], dtype=_U), both[1].astype(np.int64)


_RUNS = "kind int, shard int, n int, payload binary"


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _runs(texts: DataFrame, shard_bits: int) -> DataFrame:
    """Sorted, counted n-grams of each task, cut by shard."""
    ship_package(texts.sparkSession)
    shift = _U(64 - shard_bits)

    def flush(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        rows = []
        for kind, parts in enumerate(held):
            keys, counts = np.unique(np.concatenate(parts), return_counts=True)
            shards = (keys >> shift).astype(np.int64)
            edges = np.flatnonzero(np.diff(shards, prepend=-1))
            for a, b in zip(edges, np.append(edges[1:], len(keys)), strict=True):
                rows.append((kind, int(shards[a]), int(b - a), _pack(keys[a:b], counts[a:b])))
            parts.clear()
        return _batch(rows, ["kind", "shard", "n", "payload"], [pa.int32(), pa.int32(), pa.int32(), pa.binary()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [[], []], 0
        for batch in batches:
            for part in slices(batch.column(0)):
                own, pairs, _ = tokens(part)
                held[WORD].append(own)
                held[PAIR].append(pairs)
                n += len(own)
                if n >= FLUSH_TOKENS:
                    yield flush(held)
                    n = 0
        if n:
            yield flush(held)

    return texts.mapInArrow(run, _RUNS)


def _merge(table: pa.Table) -> pa.Table:
    """One shard's runs as one, with its number of tokens and n-grams by level."""
    kind, shard = table.column(0)[0].as_py(), table.column(1)[0].as_py()
    parts = [_unpack(p.as_py(), n.as_py()) for n, p in zip(table.column(2), table.column(3), strict=True)]
    keys, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    keys, counts = keys[edges], np.add.reduceat(counts, edges)
    levels = np.bincount(level(counts), minlength=len(_LOWEST) + 1)
    row = (kind, shard, len(keys), _pack(keys, counts), int(counts.sum()), levels.tolist())
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.list_(pa.int64())]
    return pa.Table.from_batches([_batch([row], ["kind", "shard", "n", "payload", "total", "levels"], kinds)])


class Shape(NamedTuple):
    """Where the regions of the filter lie."""

    shard_bits: int
    lowest: int  # the lowest level kept
    base: np.ndarray  # first 64-bit word of each (kind, shard)
    size: np.ndarray  # words of each (kind, shard)


def _places(keys: np.ndarray, step: int, size: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """The word of a region and the bits in it that stand for a key at a level."""
    g = mix(keys + _U(step * 0x9E3779B97F4A7C15 % (1 << 64)))
    bits = np.zeros_like(g)
    for k in range(BITS_SET):
        bits |= _U(1) << ((g >> _U(6 * k)) & _U(63))
    return ((g >> _U(32)) * _U(size) if np.isscalar(size) else (g >> _U(32)) * size) >> _U(32), bits


def _region(keys: np.ndarray, levels: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, dtype=_U)
    step = 0
    while len(keys):
        step += 1
        word, bits = _places(keys, step, size)
        np.bitwise_or.at(out, word.astype(np.int64), bits)
        more = levels > step
        keys, levels = keys[more], levels[more]
    return out


def _read(keys: np.ndarray, words: np.ndarray, base: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
    """The level of each key in the region of ``size`` words from ``base`` on, at most ``most``; 0: not there."""
    found = np.zeros(len(keys), dtype=np.int64)
    alive = np.flatnonzero(size > 0)
    step = 0
    while len(alive) and step < most:
        step += 1
        word, bits = _places(keys[alive], step, size[alive])
        there = words[base[alive] + word.astype(np.int64)]
        alive = alive[(there & bits) == bits]
        found[alive] = step
    return found


class Filter(NamedTuple):
    """Levels of n-grams, read by repeated membership probes."""

    shape: Shape
    words: np.ndarray

    def counts(self, kind: int, keys: np.ndarray) -> np.ndarray:
        """A typical count of the level of each key."""
        shape = self.shape
        region = kind * (1 << shape.shard_bits) + (keys >> _U(64 - shape.shard_bits)).astype(np.int64)
        found = _read(keys, self.words, shape.base[region], shape.size[region], len(_TYPICAL) - shape.lowest)
        return _TYPICAL[np.where(found > 0, found + shape.lowest - 1, 0)]


def _lowest(levels: np.ndarray, filter_bytes: int) -> int:
    """The lowest level with which all n-grams of it and above fit."""
    for low in range(1, len(levels)):
        entries = (levels[low:] * np.arange(1, len(levels) - low + 1)).sum()
        if entries * BITS_PER_ENTRY <= filter_bytes * 8:
            return low
    return len(levels)


def _head_level(levels: np.ndarray, head_rows: int) -> int:
    """The lowest level from which on at most ``head_rows`` words lie."""
    above = np.cumsum(levels[::-1])[::-1]
    return int(np.flatnonzero(np.append(above, 0) <= head_rows)[0]) or 1


class Counted(NamedTuple):
    counts: DataFrame  # merged runs
    shard_bits: int
    lowest: int  # the lowest level with which a filter fits the bound
    n: int  # training tokens
    v: int  # distinct words
    head_from: float  # words of at least this count are in the head
    head: np.ndarray  # sorted hashes
    head_counts: np.ndarray


class Model(NamedTuple):
    counted: Counted
    filter: Filter


def _word_rows(counts: DataFrame, low: float, high: float) -> DataFrame:
    """``(h, c)`` of the words whose count is in [low, high)."""

    def rows(batch):
        for n, payload in zip(batch.column(0), batch.column(1), strict=True):
            keys, c = _unpack(payload.as_py(), n.as_py())
            some = (c >= low) & (c < high)
            yield _batch([], ["h", "c"], [pa.int64()] * 2) if not some.any() else pa.RecordBatch.from_arrays(
                [pa.array(keys[some].view(np.int64)), pa.array(c[some])], names=["h", "c"]
            )

    return mapped(counts.where(F.col("kind") == WORD).select("n", "payload"), rows, "h long, c long")


def _filter(counts: DataFrame, shard_bits: int, lowest: int) -> Filter:
    """The filter of all n-grams from a level on, its regions built by the tasks and laid side by side."""

    def region(batch):
        rows = []
        for kind, shard, size, payload in zip(*batch.columns, strict=True):
            keys, c = _unpack(payload.as_py(), size.as_py())
            own = level(c) - lowest + 1
            keys, own = keys[own > 0], own[own > 0]
            words = int(-(-int(own.sum()) * BITS_PER_ENTRY // 64))
            rows.append((kind.as_py(), shard.as_py(), _region(keys, own, words).tobytes()))
        yield _batch(rows, ["kind", "shard", "words"], [pa.int32(), pa.int32(), pa.binary()])

    built = mapped(counts.select("kind", "shard", "n", "payload"), region, "kind int, shard int, words binary").toArrow()
    places = built.column(0).to_numpy().astype(np.int64) * (1 << shard_bits) + built.column(1).to_numpy()
    base, size = (np.zeros(2 << shard_bits, dtype=np.int64) for _ in range(2))
    sizes = pa.compute.binary_length(built.column(2)).to_numpy().astype(np.int64) // 8
    words = np.empty(int(sizes.sum()), dtype=_U)
    at, regions = 0, (x for chunk in built.column(2).chunks for x in chunk)
    for place, n, own in zip(places, sizes, regions, strict=True):
        words[at : at + n] = np.frombuffer(own.as_buffer(), "<u8")
        base[place], size[place] = at, n
        at += int(n)
    return Filter(Shape(shard_bits, lowest, base, size.astype(_U)), words)


def count(df: DataFrame, text: str, filter_bytes: int = FILTER_BYTES, head_rows: int = HEAD_ROWS) -> Counted:
    """Count all words and pairs of ``text``."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shard_bits = max(4, (4 * parts - 1).bit_length())
    runs = _runs(df.select(F.col(text).alias("text")), shard_bits)
    merged = runs.groupBy("kind", "shard").applyInArrow(_merge, f"{_RUNS}, total long, levels array<long>")
    with small_batches(spark):
        counts = stage_table(merged, "ngrams")
    sums = counts.groupBy("kind").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    by_kind = {r["kind"]: r for r in sums}
    n, v = (by_kind[WORD]["total"], by_kind[WORD]["n"]) if sums else (0, 0)
    levels = np.zeros((2, len(_LOWEST) + 1), dtype=np.int64)
    for r in counts.select("kind", F.posexplode("levels").alias("level", "k")).groupBy("kind", "level").sum("k").collect():
        levels[r[0], r[1]] = r[2]

    lowest = _lowest(levels.sum(axis=0), filter_bytes)
    head_level = _head_level(levels[WORD], head_rows)
    head_from = float(_LOWEST[head_level - 1]) if head_level <= len(_LOWEST) else float("inf")
    head = _word_rows(counts, head_from, float("inf")).toArrow()
    hashes = head.column(0).to_numpy().view(_U)
    order = np.argsort(hashes)
    return Counted(counts, shard_bits, lowest, n, v, head_from, hashes[order], head.column(1).to_numpy()[order])


def learn(df: DataFrame, text: str, filter_bytes: int = FILTER_BYTES, head_rows: int = HEAD_ROWS) -> Model:
    """Counts of ``text`` and a filter within ``filter_bytes``: of a larger one, the part of the higher levels.

    ``score`` takes such a part for no table; it reads the whole filter by shard.
    """
    counted = count(df, text, filter_bytes, head_rows)
    return Model(counted, _filter(counted.counts, counted.shard_bits, counted.lowest))


def _log_chances(seen: np.ndarray, pair: np.ndarray, begin: np.ndarray, ends: float, total: float) -> np.ndarray:
    """The log10 probability of each text, from the counts of its tokens, of its pairs and of the end."""
    before = np.empty_like(seen)
    before[1:] = seen[:-1]
    before[begin] = ends
    chance = (np.minimum(pair, before) + PRIOR * (seen + 1) / total) / (before + PRIOR)
    return np.add.reduceat(np.log10(np.minimum(chance, 1.0)), begin)


# What a block of texts asks of the shards (by kind), and where its texts use the answers.
USES = 2
_ASKED = "block long, kind int, shard int, n int, payload binary"
_ASKED_KINDS = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
_ASKED_NAMES = ["block", "kind", "shard", "n", "payload"]


def _asked(block: int, held: list[tuple[np.ndarray, np.ndarray, np.ndarray]], shard_bits: int) -> list[tuple]:
    """Distinct n-grams of a block by kind and shard; its distinct words and of each token the place among them."""
    rows = []
    for kind in (WORD, PAIR):
        keys, back = np.unique(np.concatenate([part[kind] for part in held]), return_inverse=True)
        if kind == WORD:
            words, places = keys, back
        shards = (keys >> _U(64 - shard_bits)).astype(np.int64)
        edges = np.flatnonzero(np.diff(shards, prepend=-1))
        for a, b in zip(edges, np.append(edges[1:], len(keys)), strict=True):
            rows.append((block, kind, int(shards[a]), int(b - a), _pack(keys[a:b], np.zeros(b - a, dtype=np.int64))))
    begins = np.zeros(len(places), dtype="<u4")
    at = np.cumsum([0, *(len(part[0]) for part in held)])
    begins[np.concatenate([part[2] + a for part, a in zip(held, at, strict=False)])] = 1
    planes = np.stack([places.astype("<u4"), begins]).view(np.uint8).reshape(2, -1, 4).transpose(0, 2, 1)
    payload = zstandard.ZstdCompressor(level=1).compress(words.astype("<u8").tobytes() + planes.tobytes())
    return [*rows, (block, USES, 0, len(places), payload)]


def _answered(table: pa.Table) -> pa.Table:
    """The levels that one shard's region gives for what blocks ask of it; the shard's counts have no block."""
    kind, shard = table.column(1)[0].as_py(), table.column(2)[0].as_py()
    words, asked = np.zeros(0, dtype=_U), []
    for block, n, payload in zip(table.column(0), table.column(3), table.column(4), strict=True):
        keys, counts = _unpack(payload.as_py(), n.as_py())
        if block.as_py() is None:
            own = level(counts)
            words = _region(keys, own, int(-(-int(own.sum()) * BITS_PER_ENTRY // 64)))
        else:
            asked.append((block.as_py(), keys))
    rows = []
    for block, keys in asked:
        base, size = np.zeros(len(keys), dtype=np.int64), np.full(len(keys), len(words), dtype=_U)
        found = _read(keys, words, base, size, len(_TYPICAL) - 1).astype(np.uint8)
        rows.append((block, kind, shard, len(keys), zstandard.ZstdCompressor(level=1).compress(found.tobytes())))
    return pa.Table.from_batches([_batch(rows, _ASKED_NAMES, _ASKED_KINDS)])


def _scores_by_shard(asked: DataFrame, counts: DataFrame, total: float) -> DataFrame:
    """``(uid, score)`` of the texts of all blocks; a block's name is the uid of its first text."""
    runs = counts.select(F.lit(None).cast("long").alias("block"), "kind", "shard", "n", "payload")
    answers = asked.where(F.col("kind") != USES).unionByName(runs).groupBy("kind", "shard").applyInArrow(_answered, _ASKED)

    def scored(table: pa.Table) -> pa.Table:
        levels = {}, {}
        for kind, shard, n, payload in zip(*table.columns[1:], strict=True):
            raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload.as_py()), np.uint8)
            if kind.as_py() == USES:
                cut = len(raw) - 8 * n.as_py()
                words = raw[:cut].view("<u8")
                planes = raw[cut:].reshape(2, 4, n.as_py()).transpose(0, 2, 1)
                places, begins = np.ascontiguousarray(planes).view("<u4")[:, :, 0]
            else:
                levels[kind.as_py()][shard.as_py()] = raw
        # Pairs are made again from the words: the sorted distinct ones are those that were asked for.
        own = words[places]
        back = np.unique(_pairs(own), return_inverse=True)[1]
        by_kind = (_TYPICAL[np.concatenate([found[s] for s in sorted(found)])] for found in levels)
        seen, pair = (count[use] for count, use in zip(by_kind, (places, back), strict=True))
        begin = np.flatnonzero(begins)
        # The last token of a block ends its last text.
        scores = _log_chances(seen, pair, begin, seen[-1], total)
        uids = table.column(0)[0].as_py() + np.arange(len(begin))
        return pa.table({"uid": pa.array(uids), "score": pa.array(scores)})

    return asked.where(F.col("kind") == USES).unionByName(answers).groupBy("block").applyInArrow(scored, "uid long, score double")


def score(df: DataFrame, key: str, text: str, learns: Column, **bounds: int) -> DataFrame:
    """``(key, learned, n_tokens, n_known, train_tokens, base_score, score)`` of every row.

    Learns from the rows where ``learns`` holds (null: does not) and scores all.
    ``base_score`` is the add-one unigram score from exact counts; words in frequent
    use are looked up in a broadcast head of bounded size, the rest are joined by
    hash. ``score`` is the model's log10 probability of the text and its end, at
    most 0. A null text is empty: its end is its only token. Null and repeated keys
    are returned as they are; an empty table gives no rows, and without rows to
    learn from every token has probability 1.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(learns, F.lit(False)).alias("learned"))
    model = count(rows.where("learned"), "text", **bounds)
    total = float(model.n + model.v + 1)
    by_shard, shard_bits = model.lowest > 1, model.shard_bits
    bloom = None if by_shard else _filter(model.counts, shard_bits, 1)
    sent = spark.sparkContext.broadcast((bloom, model.head, model.head_counts))
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"uid long, key {kind}, learned boolean, n_tokens long, known long, base double, score double, rare array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom, head, head_counts = sent.value
        uid = TaskContext.get().partitionId() << 33
        held, n_held, block = [], 0, uid

        def asked(like: pa.RecordBatch) -> pa.RecordBatch:
            own = _batch(_asked(block, held, shard_bits), _ASKED_NAMES, _ASKED_KINDS)
            empty = [pa.nulls(own.num_rows, c.type) for c in like.columns[: -len(_ASKED_NAMES)]]
            return pa.RecordBatch.from_arrays([*empty, *own.columns], names=like.schema.names)

        for batch in batches:
            for part in slices(batch.column(1)):
                own, pairs, begin = tokens(part)
                kinds, back = np.unique(own, return_inverse=True)
                place = np.minimum(np.searchsorted(head, kinds), max(len(head) - 1, 0))
                known = head[place] == kinds if len(head) else np.zeros(len(kinds), dtype=bool)
                exact = np.where(known, head_counts[place], 0) if len(head) else np.zeros(len(kinds))
                base = np.where(known, np.log10((exact + 1) / total), 0.0)[back]
                rare = ~known[back]
                sizes = np.diff(np.append(begin, len(own)))
                n_rare = np.add.reduceat(rare, begin, dtype=np.int64)
                offsets = np.concatenate([[0], np.cumsum(n_rare)]).astype(np.int32)
                n = len(begin)
                if by_shard:
                    scores = pa.nulls(n, pa.float64())
                else:
                    ends = bloom.counts(WORD, np.array([_END]))[0]
                    scores = _log_chances(bloom.counts(WORD, kinds)[back], bloom.counts(PAIR, pairs), begin, ends, total)
                columns = {
                    "uid": pa.array(uid + np.arange(n)),
                    "key": batch.column(0).slice(part.row, n),
                    "learned": batch.column(2).slice(part.row, n),
                    "n_tokens": pa.array(sizes.astype(np.int64)),
                    "known": pa.array(sizes - n_rare),
                    "base": pa.array(np.add.reduceat(base, begin)),
                    "score": pa.array(scores),
                    "rare": pa.ListArray.from_arrays(pa.array(offsets), pa.array(own[rare].view(np.int64))),
                }
                if by_shard:
                    columns |= {c: pa.nulls(n, t) for c, t in zip(_ASKED_NAMES, _ASKED_KINDS, strict=True)}
                out = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
                yield out
                uid += n
                if by_shard:
                    held.append((own, pairs, begin))
                    n_held += len(own)
                    if n_held >= FLUSH_TOKENS:
                        yield asked(out)
                        held, n_held, block = [], 0, uid
        if held:
            yield asked(out)

    ship_package(spark)
    with small_batches(spark):
        scored = stage_table(rows.mapInArrow(run, f"{schema}, {_ASKED}" if by_shard else schema), "scored")
    sent.destroy()  # no later step asks for it
    if by_shard:
        asked_of = scored.where(F.col("kind").isNotNull()).select(*_ASKED_NAMES)
        scored = scored.where(F.col("kind").isNull()).select("uid", "key", "learned", "n_tokens", "known", "base", "rare")
        with small_batches(spark):
            by_block = stage_table(_scores_by_shard(asked_of, model.counts, total), "block-scores")
        scored = scored.join(by_block, "uid")
    rare = scored.select("uid", F.explode("rare").alias("h"))
    found = rare.join(_word_rows(model.counts, 0, model.head_from), "h", "left").groupBy("uid")
    more = found.agg(
        F.sum(F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(total))).alias("more"), F.count("c").alias("more_known")
    )
    return scored.join(more, "uid", "left").select(
        "key",
        "learned",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        "score",
    )
