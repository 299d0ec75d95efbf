"""SimHash near-duplicates with pigeonring filtering.

A document's fingerprint has 64 bits in four segments of 16, laid on a ring. Two
fingerprints within 3 bits have a segment from which every chain of k consecutive
segments differs in at most 3k/4 bits (rounded down): the segment itself in none,
the chain of two in at most 1, of three in at most 2, of four in at most 3. So the
first segment is equal, and of the next segment at least one half is: these 24 bits
are the key under which fingerprints meet (eight keys each), and the chains prune
the pairs that meet before their full distance is taken.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.llm.components import components
from precis.llm.words import buffers, mapped
from precis.llm.xxh64 import xxh64
from precis.session import stage_table

RADIUS = 3
SEGMENTS = 4
# Rows of one key that one task compares; a key with more is refined, not cut.
BUCKET_ROWS = 4096
_TEXT_BYTES = 1 << 20


def _bits_table() -> np.ndarray:
    """For each byte a 64-bit number whose k-th byte is the k-th bit."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(bits).view("<u8").ravel()


_LANES = _bits_table()


def majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One fingerprint for each ``hashes[first[i] : first[i + 1]]``: bits set in over half; none: 0."""
    sizes = np.diff(first)
    full = np.flatnonzero(sizes)
    out = np.zeros(len(sizes), dtype=np.uint64)
    if not len(full):
        return out
    # Byte lanes count up to 255 hashes before they are widened.
    blocks = -(-sizes[full] // 255)
    block_end = np.cumsum(blocks)
    inner = np.arange(block_end[-1]) - np.repeat(block_end - blocks, blocks)
    at = np.repeat(first[:-1][full], blocks) + 255 * inner
    planes = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    counts = np.empty((len(full), 64), dtype=np.int64)
    for k in range(8):
        lanes = np.add.reduceat(_LANES[planes[:, k]], at).view(np.uint8).reshape(-1, 8)
        counts[:, 8 * k : 8 * k + 8] = np.add.reduceat(lanes, block_end - blocks, axis=0, dtype=np.int64)
    chosen = 2 * counts > sizes[full, None]
    out[full] = np.packbits(chosen, axis=1, bitorder="little").view("<u8").ravel()
    return out


def _fingerprint_slice(texts: list[bytes], shingle: int, seed: int) -> np.ndarray:
    joined, first, starts, lengths, base = [], [0], [], [], 0
    for text in texts:
        words = text.lower().split()
        joined.append(b" ".join(words))
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        begins = np.concatenate([[0], ends[:-1] + 1]) if len(words) else ends
        n = min(shingle, len(words))
        begin = begins[: len(words) - n + 1] if n else begins
        starts.append(begin + base)
        lengths.append((ends[n - 1 :] if n else ends) - begin)
        first.append(first[-1] + len(begin))
        base += len(joined[-1])
    data = np.frombuffer(b"".join(joined), np.uint8)
    hashes = xxh64(data, np.concatenate(starts), np.concatenate(lengths), seed)
    return majority(hashes, np.array(first))


def fingerprints(df: DataFrame, key: str, text: str, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``(key, fp)`` of every row: bit b is set if it is set in over half of the shingle hashes.

    Words are runs without space and ``\\x09``-``\\x0D``, with A-Z lowered. Shingles
    keep their repeats; a text of fewer words is one shingle, a null text or one
    without words has fingerprint 0. Whole texts are read.
    """

    def fingerprint(batch):
        data, bounds = buffers(batch.column(1))
        out = np.empty(batch.num_rows, dtype=np.uint64)
        row = 0
        while row < len(out):
            end = int(np.searchsorted(bounds, bounds[row] + _TEXT_BYTES, "right")) - 1
            end = min(max(end, row + 1), len(out))
            texts = [data[a:b].tobytes() for a, b in zip(bounds[row:end], bounds[row + 1 : end + 1], strict=True)]
            out[row:end] = _fingerprint_slice(texts, shingle, seed)
            row = end
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], names=["key", "fp"])

    kind = df.schema[key].dataType.simpleString()
    return mapped(df.select(F.col(key).alias("key"), F.col(text).alias("text")), fingerprint, f"key {kind}, fp long")


def _cut(fp: Column, low: int, n: int) -> Column:
    """Bits ``low`` to ``low + n - 1`` of a fingerprint."""
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << n) - 1))


def _first_keys(fp: Column) -> Column:
    """The eight (segment, half of the next segment) keys of a fingerprint."""
    keys = []
    for s in range(SEGMENTS):
        segment, after = _cut(fp, 16 * s, 16), 16 * ((s + 1) % SEGMENTS)
        for half in range(2):
            value = segment * 256 + _cut(fp, after + 8 * half, 8)
            keys.append(F.lit(2 * s + half) * (1 << 24) + value)
    return F.array(*keys)


def _fixed(way: int) -> int:
    """The bits that key ``way`` holds equal, as a mask."""
    s, half = divmod(way, 2)
    return (0xFFFF << 16 * s) | (0xFF << (16 * ((s + 1) % SEGMENTS) + 8 * half))


def _free_parts(mask: int) -> list[int]:
    """The bits outside ``mask`` dealt to RADIUS + 1 parts, one of which is equal for every linked pair."""
    free = [b for b in range(64) if not mask >> b & 1]
    parts = [free[i :: RADIUS + 1] for i in range(RADIUS + 1)]
    return [sum(1 << b for b in part) for part in parts if part]


def chains_hold(diff: np.ndarray, radius: int = RADIUS, segments: int = SEGMENTS) -> np.ndarray:
    """Does a chain from some segment keep its budget at each length?"""
    width = 64 // segments
    mask = np.uint64((1 << width) - 1)
    own = [np.bitwise_count((diff >> np.uint64(width * s)) & mask).astype(np.int64) for s in range(segments)]
    good = np.zeros(diff.shape, dtype=bool)
    for s in range(segments):
        total, holds = np.zeros(diff.shape, dtype=np.int64), np.ones(diff.shape, dtype=bool)
        for k in range(segments):
            total = total + own[(s + k) % segments]
            holds &= total <= radius * (k + 1) // segments
        good |= holds
    return good


def _forest(fps: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what linked pairs connect, at most one less than there are fingerprints."""
    links, todo = [], np.arange(len(fps))
    while len(todo):
        reached, todo = todo[:1], todo[1:]
        while len(reached) and len(todo):
            at, reached = reached[0], reached[1:]
            diff = fps[todo] ^ fps[at]
            near = _near(diff)
            new = todo[near]
            links += [(at, j) for j in new]
            reached, todo = np.concatenate([reached, new]), todo[~near]
    return links


def _near(diff: np.ndarray) -> np.ndarray:
    """Pairs within the radius: the chains first, the full distance of those that remain."""
    near = chains_hold(diff)
    near[near] = np.bitwise_count(diff[near]) <= RADIUS
    return near


def _bucket_links(batch):
    out = [], []
    for fps in batch.column(0):
        values = np.asarray(fps.values, dtype=np.int64)
        for i, j in _forest(values.view(np.uint64)):
            out[0].append(values[i])
            out[1].append(values[j])
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["a", "b"])


def _masks() -> list[int]:
    return [_fixed(w) for w in range(2 * SEGMENTS)]


def links(fps: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct fingerprints ``fp`` within the radius.

    Fingerprints that share a key are compared in one task when there are at most
    ``bucket_rows``. The rest of a fuller key is dealt anew under four longer keys:
    its free bits in four parts, one of which any linked pair has in common. That
    repeats until all fit; at most 2**k fingerprints share all but k bits, so it ends.
    """
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    rows = fps.select("fp", F.posexplode(_first_keys(F.col("fp"))).alias("way", "key"))
    rows = rows.select("fp", F.array("way").alias("path"), "key", F.element_at(
        F.array(*[F.lit(signed(m)) for m in _masks()]), F.col("way") + 1).alias("mask"))
    found = []
    while True:
        rows = stage_table(rows, "simhash-keys")
        sizes = rows.groupBy("path", "key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        sized = stage_table(rows.join(sizes, ["path", "key"]), "simhash-meet")
        small = sized.where(F.col("_n") <= bucket_rows).groupBy("path", "key").agg(F.collect_list("fp").alias("fps"))
        found.append(mapped(small.select("fps"), _bucket_links, "a long, b long"))
        full = sized.where(F.col("_n") > bucket_rows)
        masks = [r[0] for r in full.select("mask").distinct().collect()]
        if not masks:
            break
        parts = F.create_map(*[
            x for m in masks for x in (F.lit(m), F.array(*[F.lit(signed(p)) for p in _free_parts(m % (1 << 64))]))
        ])
        rows = full.select("fp", "path", "mask", F.posexplode(parts[F.col("mask")]).alias("part", "bits")).select(
            "fp",
            F.concat("path", F.array("part")).alias("path"),
            F.col("fp").bitwiseAND(F.col("mask").bitwiseOR(F.col("bits"))).alias("key"),
            F.col("mask").bitwiseOR(F.col("bits")).alias("mask"),
        )
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(df: DataFrame, key: str, text: str, shingle: int = 3) -> DataFrame:
    """``(key, fp, component)`` of every row; ``component`` is the smallest key reached by links.

    Documents link if their fingerprints differ in at most 3 bits; equal
    fingerprints always do, also those of texts without words (0). A null key is
    never a component's name; a component of null keys only has a null name.
    Repeated keys give a row each. An empty table gives no rows. Fingerprints are
    staged once; only distinct ones are compared, and no group meets in one task.
    """
    own = stage_table(fingerprints(df, key, text, shingle), "simhash")
    distinct = own.groupBy("fp").agg(F.min("key").alias("least"))
    distinct = stage_table(distinct, "simhash-distinct")
    member = components(links(distinct.select("fp")))
    named = distinct.join(member.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    names = named.groupBy("component").agg(F.min("least").alias("name"))
    name_of = named.join(names, "component").select("fp", F.col("name").alias("component"))
    return own.join(name_of, "fp").select("key", "fp", "component")
