"""Benchmark passages in documents, found by SimHash over item-sized windows.

Every window of a document that has as many words as a benchmark item gets a 64-bit
SimHash over its shingles, repeats counted. The items' fingerprints lie in a
multi-index: RADIUS + 1 blocks of bits, of which two fingerprints within RADIUS
bits share at least one, so no item within the radius is missed. Those found are
held against the window by the exact similarity of their weighted shingles
(smaller counts over larger counts). At similarity 0.8 the fingerprints differ in
about 10 of 64 bits with a deviation of 3, so the radius of 20 leaves out none but
a pair in some thousands just above the threshold.

A window that shares no shingle with an item has similarity 0 to it. So windows that
share none with any item are passed over before they are fingerprinted, and the
multi-index of a text holds the items only that have a shingle in it.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.llm.words import Range, Slice, mapped, slices
from precis.session import stage_table

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 20
# Benchmark text that is broadcast at once; a larger benchmark takes several passes.
BLOCK_BYTES = 4 << 20

Found = tuple[int, int, int, int, float]  # row, item, start, distance, similarity


def _prints(bits: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of ranges of shingles; ``bits`` are running sums of +1 and -1."""
    ahead = bits[end] - bits[first] > 0
    return np.packbits(ahead, axis=1, bitorder="little").view("<u8").ravel()


def _running(hashes: np.ndarray) -> np.ndarray:
    signs = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out = np.zeros((len(hashes) + 1, 64), dtype=np.int32)
    np.cumsum(2 * signs.astype(np.int32) - 1, axis=0, out=out[1:])
    return out


def _weights(words: list[bytes], size: int) -> Counter:
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Sum of the smaller counts over the sum of the larger ones; 0 where both are empty."""
    both = sum((a & b).values())
    either = sum(a.values()) + sum(b.values()) - both
    return both / either if either else 0.0


class Index:
    """Items by number of words, with a multi-index of their fingerprints."""

    def __init__(self, texts: list[str | None], shingle: int, similarity: float, radius: int):
        self.similarity, self.radius, self.shingle = similarity, radius, shingle
        cuts = np.linspace(0, 64, radius + 2).astype(int)
        self.blocks = [(int(a), (1 << int(b - a)) - 1) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        sizes, known = defaultdict(list), defaultdict(list)
        self.weights = {}
        at = 0
        for part in slices(pa.array(texts, pa.string())):
            ranges = Range(part.hashes)
            for i in range(len(part.bounds) - 1):
                a, b = int(part.first[i]), int(part.first[i + 1])
                if a == b:
                    continue
                n = min(shingle, b - a)
                begin = np.arange(a, b - n + 1)
                hashes = ranges.hash(begin, begin + n)
                fp = _prints(_running(hashes), np.array([0]), np.array([len(hashes)]))[0]
                sizes[b - a].append((at + i, fp))
                own = np.unique(hashes)
                known[n].append((own, np.full(len(own), at + i)))
                words = [w.lower() for w in part.data[part.bounds[i] : part.bounds[i + 1]].tobytes().split()]
                self.weights[at + i] = _weights(words, n)
            at += len(part.bounds) - 1
        # Of each shingle size the distinct hashes, and where the items of each begin in a list.
        self.known, self.holders = {}, {}
        for n, parts in known.items():
            hashes, items = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(hashes, kind="stable")
            self.known[n], first = np.unique(hashes[order], return_index=True)
            self.holders[n] = np.append(first, len(hashes)), items[order]
        self.by_size = {}
        for size, items in sizes.items():
            prints = np.array([fp for _, fp in items], dtype=np.uint64)
            meets = []
            for low, mask in self.blocks:
                values = (prints >> np.uint64(low)) & np.uint64(mask)
                meets.append(np.arange(mask + 1, dtype=np.uint64)[:, None] == values[None, :])
            self.by_size[size] = (np.array([i for i, _ in items]), prints, meets)

    def near(self, size: int, prints: np.ndarray, held: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(window, item, distance) of the items ``held`` of a size within the radius."""
        items, own, meets = self.by_size[size]
        some = np.flatnonzero(np.isin(items, held))
        items, own, meets = items[some], own[some], [table[:, some] for table in meets]
        for at in range(0, len(prints), 1024):
            some = prints[at : at + 1024]
            share = np.zeros((len(some), len(items)), dtype=bool)
            for (low, mask), table in zip(self.blocks, meets, strict=True):
                share |= table[((some >> np.uint64(low)) & np.uint64(mask)).astype(np.int64)]
            w, i = np.nonzero(share)
            distance = np.bitwise_count(some[w] ^ own[i])
            for k in np.flatnonzero(distance <= self.radius):
                yield int(w[k]) + at, int(items[i[k]]), int(distance[k])

    def search(self, part: Slice) -> Iterator[Found]:
        """The best window for each row of the slice and each item it holds."""
        ranges = Range(part.hashes)
        n_words = len(part.hashes)
        for n, known in self.known.items():
            begin = np.arange(max(0, n_words - n + 1))
            row = np.searchsorted(part.first, begin, "right") - 1
            inside = begin + n <= part.first[row + 1]
            begin, row = begin[inside], row[inside]
            hashes = ranges.hash(begin, begin + n)
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hit = known[place] == hashes
            if not hit.any():
                continue
            begin, row, place = begin[hit], row[hit], place[hit]
            bounds, holders = self.holders[n]
            edges = np.flatnonzero(np.diff(row, prepend=-1))
            for a, b in zip(edges, np.append(edges[1:], len(row)), strict=True):
                hashes = np.unique(place[a:b])
                held = np.unique(np.concatenate([holders[bounds[h] : bounds[h + 1]] for h in hashes]))
                yield from self._row(part, ranges, int(row[a]), n, begin[a:b], held)

    def _row(self, part: Slice, ranges: Range, row: int, n: int, hits: np.ndarray, held: np.ndarray) -> Iterator[Found]:
        a, b = int(part.first[row]), int(part.first[row + 1])
        begin = np.arange(a, b - n + 1)
        running = _running(ranges.hash(begin, begin + n))
        words, best = None, {}
        for size, (items, *_) in self.by_size.items():
            if min(self.shingle, size) != n or not np.isin(items, held).any():
                continue
            size_here = min(size, b - a)
            # Windows with a hit: from the last start before it to the hit itself.
            reach = np.zeros(b - a - size_here + 2, dtype=np.int64)
            low = np.clip(hits - a + n - size_here, 0, len(reach) - 1)
            high = np.clip(hits - a + 1, 0, len(reach) - 1)
            np.add.at(reach, low, 1)
            np.add.at(reach, high, -1)
            starts = np.flatnonzero(np.cumsum(reach[:-1]) > 0)
            if not len(starts):
                continue
            prints = _prints(running, starts, starts + size_here - n + 1)
            for w, item, distance in self.near(size, prints, held):
                if words is None:
                    text = part.data[part.bounds[row] : part.bounds[row + 1]].tobytes()
                    words = text.lower().split()
                at = int(starts[w])
                weights = _weights(words[at : at + size_here], n)
                similarity = weighted_similarity(weights, self.weights[item])
                found = (similarity, -at, distance)
                if similarity >= self.similarity and found > best.get(item, (0.0,)):
                    best[item] = found
        for item, (similarity, start, distance) in best.items():
            yield part.row + row, item, -start, distance, similarity


_indexes: dict[str, Index] = {}


def _blocks(benchmark: DataFrame, key: str, text: str, block_bytes: int) -> Iterator[list[tuple]]:
    """The items of the benchmark, ``block_bytes`` of text at a time."""
    block, size = [], 0
    for r in benchmark.select(F.col(key).alias("key"), F.col(text).alias("text")).toLocalIterator():
        n = len((r["text"] or "").encode())
        if block and size + n > block_bytes:
            yield block
            block, size = [], 0
        block.append((r["key"], r["text"]))
        size += n
    if block:
        yield block


def _searched(rows: DataFrame, schema: str, benchmark: DataFrame, key: str, text: str, options: tuple, block_bytes: int, found):
    """The rows of ``schema`` that ``found(batch, index, item keys)`` gives for each block of the benchmark.

    One block is on the workers at a time: its rows are written before the next one is sent.
    """
    context = rows.sparkSession.sparkContext
    item_type = benchmark.select(key).limit(0).toArrow().schema.field(0).type
    out = None
    for block in _blocks(benchmark, key, text, block_bytes):
        sent, name = context.broadcast(block), uuid.uuid4().hex

        def search(batch, sent=sent, name=name):
            if name not in _indexes:
                _indexes.clear()
                _indexes[name] = Index([t for _, t in sent.value], *options)
            yield from found(batch, _indexes[name], pa.array([k for k, _ in sent.value], item_type))

        some = stage_table(mapped(rows, search, schema), "contamination")
        sent.destroy()
        out = some if out is None else out.unionByName(some)
    return rows.sparkSession.createDataFrame([], schema) if out is None else out


def contamination(
    df: DataFrame,
    key: str,
    text: str,
    benchmark: DataFrame,
    item_key: str,
    item_text: str,
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(key, item, start, distance, similarity)``: the best window for each row and benchmark item it holds.

    A window has as many words as the item; a text with fewer words is one window.
    Words are runs without space and ``\\x09``-``\\x0D`` with A-Z lowered; an item of
    fewer than ``shingle`` words is one shingle. Of equal similarities the first
    window counts. Null or wordless texts and items hold nothing; null keys are
    returned as they are, repeated rows and items each for themselves, and empty
    tables give no rows. Keys of both tables may be of any type. Nothing is shuffled; the
    benchmark is broadcast in blocks of ``block_bytes``, one at a time, and the documents
    are read once for each block, whose rows are written.
    """
    kinds = df.schema[key].dataType.simpleString(), benchmark.schema[item_key].dataType.simpleString()
    schema = f"key {kinds[0]}, item {kinds[1]}, start long, distance int, similarity double"
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def found(batch, index, items):
        hits = [f for part in slices(batch.column(1)) for f in index.search(part)]
        columns = list(zip(*hits, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(columns[0], pa.int64())),
                items.take(pa.array(columns[1], pa.int64())),
                pa.array(columns[2], pa.int64()),
                pa.array(columns[3], pa.int32()),
                pa.array(columns[4], pa.float64()),
            ],
            names=["key", "item", "start", "distance", "similarity"],
        )

    options = (shingle, similarity, radius)
    return _searched(rows, schema, benchmark, item_key, item_text, options, block_bytes, found)


def decontaminated(
    df: DataFrame,
    text: str,
    benchmark: DataFrame,
    item_text: str,
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``df``, all columns, whose text holds no item of the benchmark (see ``contamination``).

    What is written for a block are the hashes of the texts that hold an item of it, so
    repeated keys and rows don't matter and texts are not copied; equal texts go together.
    """
    rows = df.select(F.xxhash64(text, F.octet_length(text)).alias("key"), F.col(text).alias("text"))

    def found(batch, index, items):
        hits = {row for part in slices(batch.column(1)) for row, *_ in index.search(part)}
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(sorted(hits), pa.int64()))], names=["key"])

    options = (shingle, similarity, radius)
    dirty = _searched(rows, "key long", benchmark, item_text, item_text, options, block_bytes, found)
    dirty = dirty.distinct().withColumnRenamed("key", "_dirty")
    return df.join(dirty, F.xxhash64(text, F.octet_length(text)) == F.col("_dirty"), "left_anti")
