"""Near-copies: SimHash with pigeonring filtering at a radius that reaches similarity 0.8.

Texts are near-copies if their sets of five-word shingles have a Jaccard similarity
of at least 0.8. Their 64-bit SimHashes then differ in about 10 bits with a deviation
of 3, so the radius is 20 bits, and no key of bits alone could bring such pairs
together and leave others apart. Texts meet under their own least shingle hashes
instead: of each text the MEET smallest. In a pair at similarity 0.8 every hash of
the union is shared with probability 0.8, so the four smallest of both are disjoint
about twice in ten thousand. Among the texts that meet, pigeonring chains prune the
pairs, then the full Hamming distance, and the exact sets of shingles decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.llm.components import components
from precis.llm.simhash import chains_hold, majority
from precis.llm.words import Range, mapped, slices, small_batches
from precis.session import stage_table

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 20
SEGMENTS = 8
# Least shingle hashes under which a text meets others, and those that divide a hot group.
MEET = 4
KEYS = 12
# Rows and shingles that meet in one task; a fuller group is divided, not cut.
GROUP_ROWS = 4096
GROUP_SHINGLES = 2_000_000
LEVELS = 3


def _shingles(texts: pa.Array, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of every text in order: the hash of all its words, and its distinct shingle hashes, ascending."""
    for part in slices(texts):
        ranges = Range(part.hashes)
        whole = ranges.hash(part.first[:-1], part.first[1:])
        for i, (a, b) in enumerate(zip(part.first[:-1], part.first[1:], strict=True)):
            n = min(size, int(b - a))
            begin = np.arange(a, b - n + 1) if n else np.arange(0)
            yield whole[i : i + 1], np.unique(ranges.hash(begin, begin + n))


def _sketches(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, id, fp, n, least)``: words' hash, SimHash, distinct shingles and the least of them."""

    def sketch(batch):
        ids, sets = [], []
        for whole, own in _shingles(batch.column(1), SHINGLE):
            ids.append(whole)
            sets.append(own)
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        first = np.concatenate([[0], np.cumsum(sizes)])
        every = np.concatenate([*sets, np.zeros(0, np.uint64)])
        least = np.concatenate([*[own[:KEYS] for own in sets], np.zeros(0, np.uint64)])
        ends = np.concatenate([[0], np.cumsum(np.minimum(sizes, KEYS))])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(np.concatenate([*ids, np.zeros(0, np.uint64)]).view(np.int64)),
                pa.array(majority(every, first).view(np.int64)),
                pa.array(sizes),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(least.view(np.int64))),
            ],
            names=["key", "id", "fp", "n", "least"],
        )

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return mapped(rows, sketch, f"key {kind}, id long, fp long, n long, least array<long>")


def _may_link(fps: np.ndarray, sizes: np.ndarray, at: int, others: np.ndarray) -> np.ndarray:
    """Which of ``others`` may be near-copies of ``at``: sizes, then chains, then the full distance."""
    low, high = np.minimum(sizes[others], sizes[at]), np.maximum(sizes[others], sizes[at])
    open_ = np.flatnonzero(low >= SIMILARITY * high)
    open_ = open_[chains_hold(fps[others[open_]] ^ fps[at], RADIUS, SEGMENTS)]
    open_ = open_[np.bitwise_count(fps[others[open_]] ^ fps[at]) <= RADIUS]
    return others[open_]


def _partners(batch):
    """Of each group the members that may be near-copies of another member."""
    groups, ids = [], []
    for group, members in zip(batch.column(0), batch.column(1), strict=True):
        m = members.values
        own, fps, sizes = (np.asarray(m.field(i), np.int64) for i in range(3))
        fps = fps.view(np.uint64)
        found = np.zeros(len(own), dtype=bool)
        for i in range(len(own)):
            # A member with a partner need not look for one, but others may find it.
            if found[i]:
                continue
            some = _may_link(fps, sizes, i, np.delete(np.arange(len(own)), i))
            found[some] = True
            found[i] = len(some) > 0
        groups += [group.as_py()] * int(found.sum())
        ids += own[found].tolist()
    yield pa.RecordBatch.from_arrays([pa.array(groups, pa.int64()), pa.array(ids, pa.int64())], names=["grp", "id"])


def _alike(codes: list[np.ndarray], sizes: np.ndarray, marks: np.ndarray, at: int, others: np.ndarray) -> np.ndarray:
    """Which of ``others`` have a similarity of 0.8 or more to ``at``; ``marks`` is all false before and after."""
    if not len(others):
        return others
    marks[codes[at]] = True
    first = np.concatenate([[0], np.cumsum(sizes[others])[:-1]])
    both = np.add.reduceat(marks[np.concatenate([codes[j] for j in others])], first, dtype=np.int64)
    marks[codes[at]] = False
    return others[both >= SIMILARITY * (sizes[at] + sizes[others] - both)]


def _forest(batch):
    """Links that connect what near-copies of a group connect, fewer than there are members."""
    out = [], []
    for members in batch.column(0):
        m = members.values
        own, fps = np.asarray(m.field(0), np.int64), np.asarray(m.field(1), np.int64).view(np.uint64)
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in m.field(2)]
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        known, places = np.unique(np.concatenate(sets), return_inverse=True)
        codes, marks = np.split(places, np.cumsum(sizes)[:-1]), np.zeros(len(known), dtype=bool)
        todo = np.arange(len(own))
        while len(todo) > 1:
            reached, todo = [int(todo[0])], todo[1:]
            while reached and len(todo):
                at = reached.pop()
                near = _alike(codes, sizes, marks, at, _may_link(fps, sizes, at, todo))
                out[0].extend([own[at]] * len(near))
                out[1].extend(own[near])
                reached += near.tolist()
                todo = np.setdiff1d(todo, near, assume_unique=True)
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["a", "b"])


def _divided(full: DataFrame) -> DataFrame:
    """Groups dealt anew under one more of the members' least hashes."""
    more = full.withColumn("next", F.explode(F.array_except("least", "path")))
    return more.select("id", "fp", "n", "least", F.array_sort(F.array_append("path", F.col("next"))).alias("path")).distinct()


def _in_cells(full: DataFrame, rows: int, shingles: int) -> DataFrame:
    """Groups that no further hash divides: dealt to blocks, each pair of blocks a group of its own."""
    blocks = F.ceil(F.greatest(2 * F.col("rows") / rows, 2 * F.col("shingles") / shingles)).cast("int")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = full.withColumn("blocks", blocks).withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = F.array(F.least("own", "other").cast("long"), F.greatest("own", "other").cast("long"))
    return dealt.select("id", "fp", "n", F.xxhash64(F.concat("path", cell)).alias("grp"))


def _groups(texts: DataFrame, rows: int, shingles: int) -> DataFrame:
    """``(grp, id, fp, n)``: the groups in which texts meet, each within the bounds."""
    path = F.transform(F.slice("least", 1, MEET), lambda h: F.array(h))
    open_ = texts.select("id", "fp", "n", "least", F.explode(path).alias("path"))
    out = None
    for level in range(1, LEVELS + 1):
        open_ = stage_table(open_, "copies-keys")
        sums = open_.groupBy("path").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles"))
        met = stage_table(open_.join(sums.where("rows > 1"), "path"), "copies-met")
        fits = (F.col("rows") <= rows) & (F.col("shingles") <= shingles) | (F.col("rows") == 2)
        done = met.where(fits).select("id", "fp", "n", F.xxhash64("path").alias("grp"))
        out = done if out is None else out.unionByName(done)
        full = met.where(~fits)
        if full.isEmpty():
            break
        # A text with no further hash has its whole set in the path, as its near-copies then have.
        rest = full if level == LEVELS else full.where(F.size(F.array_except("least", "path")) == 0)
        out = out.unionByName(_in_cells(rest, rows, shingles))
        open_ = _divided(full)
    return out


def near_copies(
    df: DataFrame, key: str, text: str, group_rows: int = GROUP_ROWS, group_shingles: int = GROUP_SHINGLES
) -> DataFrame:
    """``(key, component)`` of every row; ``component`` is the smallest key reached by links.

    Words are runs without space and ``\\x09``-``\\x0D`` with A-Z lowered. Texts of the
    same words are linked, those without words too (null counts as empty); others if
    their sets of five-word shingles have a Jaccard similarity of 0.8 or more; fewer
    words are one shingle. Repeated keys give a row each, null keys sort first, an
    empty table gives no rows. Each link is verified on the exact sets. Texts of the
    same words are compared once; only those with a possible partner are read again.
    Groups of more than ``group_rows`` texts or ``group_shingles`` shingles are divided
    by further hashes of their members, then into pairs of blocks; none is cut.
    """
    spark = df.sparkSession
    own = stage_table(_sketches(df, key, text), "copies")
    texts = own.groupBy("id").agg(*[F.first(c).alias(c) for c in ("fp", "n", "least")], F.min("key").alias("name"))
    texts = stage_table(texts, "copies-distinct")
    groups = stage_table(_groups(texts.drop("name"), group_rows, group_shingles), "copies-groups")

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def gathered(rows: DataFrame, *columns: str) -> DataFrame:
        # As many tasks as the session names: small rows that mean much work must not be merged into one.
        members = F.collect_list(F.struct(*columns)).alias("members")
        return rows.repartition(tasks, "grp").groupBy("grp").agg(members).where(F.size("members") > 1)

    with small_batches(spark, 256):
        some = mapped(gathered(groups, "id", "fp", "n"), _partners, "grp long, id long")
        some = stage_table(some.distinct(), "copies-partners")
    wanted = texts.join(some.select("id").distinct(), "id", "left_semi")
    sets = stage_table(_sets(df, key, text, wanted), "copies-sets")
    with small_batches(spark, 32):
        joined = some.join(sets, "id").join(texts.select("id", "fp"), "id")
        links = stage_table(mapped(gathered(joined, "id", "fp", "set").select("members"), _forest, "a long, b long"), "copies-links")
    member = components(links).withColumnRenamed("node", "id")
    named = texts.join(member, "id", "left").withColumn("component", F.coalesce("component", "id"))
    names = named.groupBy("component").agg(F.min("name").alias("least_name"))
    name_of = named.join(names, "component").select("id", F.col("least_name").alias("component"))
    return own.join(name_of, "id").select("key", "component")


def _sets(df: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """``(id, set)``, one row for each id, of at least the texts whose keys are wanted: shingle hashes as bytes."""

    def identify(batch):
        ids, sets = [np.zeros(0, np.uint64)], []
        for whole, own in _shingles(batch.column(0), SHINGLE):
            ids.append(whole)
            sets.append(own.tobytes())
        ids = np.concatenate(ids).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(sets, pa.binary())], names=["id", "set"])

    rows = df.select(F.xxhash64(key).alias("mark"), F.col(text).alias("text"))
    rows = rows.join(wanted.select(F.xxhash64("name").alias("mark")), "mark", "left_semi")
    return mapped(rows.select("text"), identify, "id long, set binary").dropDuplicates(["id"])
