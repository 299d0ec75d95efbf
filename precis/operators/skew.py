"""Building blocks that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, LongType, StringType, StructField, StructType

from precis.session import ship_package, stage_table

# Broadcast heads hold at most this many keys, with text values of at most this many bytes.
# Joins take a 128-bit hash for the key, 28 MB at worst; arrays the key itself, of at most
# this many bytes too, 52 MB at worst. A few megabytes as a rule.
HEAD_ROWS = 100_000
HEAD_VALUE_BYTES = 256
# Rows per block in two-level running aggregates.
BLOCK_ROWS = 65_536
# Values are counted in runs of so many bytes, and their counts meet in so many parts for each part of the input.
RUN_BYTES = 64_000_000
PARTS_FOR_ONE = 4


_HASH = ("_head_a", "_head_b")


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """An equal join in which a null key meets a null key; the key columns are those of ``left``."""
    named = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on]
    return left.join(named, reduce(Column.__and__, same), how).drop(*[f"_right_{c}" for c in on])


def value_counts(df: DataFrame, column: str, count: str) -> DataFrame:
    """``(column, count)``: how often each value occurs; a null counts as a value.

    Each task counts runs of values as they come and keeps nothing of an earlier run,
    so a hot value is a few rows and no table of all values of a task is held. The
    counts meet in parts whose number grows with that of the input's, and is at least
    ``spark.sql.shuffle.partitions``: memory follows the size of one part of the input.
    Parts of ``df`` are numbered by planning it: pass a plan without shuffles.
    """
    spark = df.sparkSession
    ship_package(spark)
    values = df.select(column)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), PARTS_FOR_ONE * values.rdd.getNumPartitions())

    def counted(run):
        found = pa.chunked_array(run).value_counts()
        return pa.RecordBatch.from_arrays(list(found.flatten()), names=[column, count])

    def runs(batches):
        run, size = [], 0
        for batch in batches:
            run.append(batch.column(0))
            size += batch.nbytes
            if size >= RUN_BYTES:
                yield counted(run)
                run, size = [], 0
        if run:
            yield counted(run)

    schema = StructType([values.schema[column], StructField(count, LongType(), False)])
    dealt = values.mapInArrow(runs, schema).repartition(parts, column)
    return dealt.groupBy(column).agg(F.coalesce(F.sum(count), F.lit(0)).alias(count))


def hashed(df: DataFrame, on: str) -> DataFrame:
    """``df`` with two 64-bit hashes of ``on``; two keys that agree in both do not occur in practice."""
    return df.withColumns({_HASH[0]: F.xxhash64(on), _HASH[1]: F.xxhash64(F.lit("head"), on)})


def head_of(dim: DataFrame, on: str, weight: str, head_rows: int = HEAD_ROWS) -> DataFrame:
    """The heaviest keys of ``dim`` by hash, with its other columns: small enough to broadcast whatever the data."""
    texts = [f.name for f in dim.schema if f.name != on and f.dataType == StringType()]
    known = dim.where(F.col(on).isNotNull())
    for c in texts:
        known = known.where(F.coalesce(F.octet_length(c), F.lit(0)) <= HEAD_VALUE_BYTES)
    return F.broadcast(hashed(known, on).orderBy(F.desc(weight), *_HASH).limit(head_rows).drop(on))


def lookup_join(
    rows: DataFrame, dim: DataFrame, on: str, weight: str, head_rows: int = HEAD_ROWS
) -> DataFrame:
    """Inner join of ``rows`` to the unique keys of ``dim`` without a hot shuffle key.

    ``weight`` says how often a key occurs. The heaviest ``head_rows`` keys are
    broadcast; any other key then holds less than 1/``head_rows`` of the rows and
    is joined by a shuffle. The result equals a plain join, so a null key meets
    nothing. Both inputs are read more than once: pass tables, not long plans.
    """
    head = head_of(dim, on, weight, head_rows)
    keyed = hashed(rows, on)
    hot = keyed.join(head, list(_HASH)).drop(*_HASH)
    cold = keyed.join(head.select(*_HASH), list(_HASH), "left_anti").drop(*_HASH)
    cold = cold.join(dim.hint("shuffle_merge"), on)
    return hot.select(*cold.columns).unionByName(cold)


def _broadcast_head(dim: DataFrame, on: str, value: str, weight: str, head_rows: int) -> tuple[Broadcast, bool]:
    """The heaviest keys and their values as two Arrow arrays on every worker, and whether these are all keys."""
    known = dim.where(F.col(on).isNotNull())
    short = known
    for c in (on, value):
        if dim.schema[c].dataType == StringType():
            short = short.where(F.coalesce(F.octet_length(c), F.lit(0)) <= HEAD_VALUE_BYTES)
    head = short.orderBy(F.desc(weight), on).limit(head_rows).select(on, value).toArrow().combine_chunks()
    arrays = tuple(head.column(c).combine_chunks() for c in (on, value))
    return dim.sparkSession.sparkContext.broadcast(arrays), head.num_rows == known.count()


def _ends(counts: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())


def _found_in(head: Broadcast, on_type: DataType, value_type: DataType) -> Callable[[Column], Column]:
    """A function on arrays of keys: their values, and place and key of those that the head lacks."""
    open_type = StructType([StructField("pos", IntegerType()), StructField("on", on_type)])
    out = StructType([StructField("values", ArrayType(value_type)), StructField("late", ArrayType(open_type))])

    def look(lists: pa.Array) -> pa.Array:
        keys, values = head.value
        flat = lists.flatten()
        places = pc.index_in(flat, value_set=keys.cast(flat.type))
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        open_ = np.flatnonzero(pc.and_(places.is_null(), flat.is_valid()).to_numpy(zero_copy_only=False))
        row = np.repeat(np.arange(len(lists)), sizes)[open_]
        pos = open_ - np.concatenate([[0], np.cumsum(sizes)])[row]
        late = pa.StructArray.from_arrays([pa.array(pos, pa.int32()), flat.take(pa.array(open_))], names=["pos", "on"])
        return pa.StructArray.from_arrays(
            [
                pa.ListArray.from_arrays(_ends(sizes), values.take(places)),
                pa.ListArray.from_arrays(_ends(np.bincount(row, minlength=len(lists))), late),
            ],
            names=["values", "late"],
        )

    # Marked so that Spark runs it in a step of its own, once a row.
    return F.arrow_udf(look, out).asNondeterministic()


def _patched(value_type: DataType) -> Callable[[Column, Column], Column]:
    """A function on arrays and ``(pos, value)`` arrays that puts the values in their places."""

    def patch(lists: pa.Array, late: pa.Array) -> pa.Array:
        flat, more = lists.flatten(), late.flatten()
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        n_late = pc.fill_null(pc.list_value_length(late), 0).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        at = np.repeat(starts, n_late) + more.field("pos").to_numpy(zero_copy_only=False)
        take = np.arange(len(flat))
        take[at] = len(flat) + np.arange(len(more))
        both = pa.concat_arrays([flat, more.field("value").cast(flat.type)])
        return pa.ListArray.from_arrays(_ends(sizes), both.take(pa.array(take)))

    return F.arrow_udf(patch, ArrayType(value_type)).asNondeterministic()


def _tagged(late: str, of: int) -> Column:
    return F.transform(late, lambda x: F.struct(F.lit(of).alias("of"), x["pos"].alias("pos"), x["on"].alias("on")))


def _of(i: int) -> Column:
    return F.filter("_late", lambda x: x["of"] == i)


def lookup_arrays(
    df: DataFrame,
    keep: Sequence[str],
    arrays: Mapping[str, Column],
    dim: DataFrame,
    on: str,
    value: str,
    weight: str,
    head_rows: int = HEAD_ROWS,
) -> DataFrame:
    """The columns ``keep`` and, under each name, its array with ``value`` of every element's ``on`` key in ``dim``.

    A value is NULL where ``dim`` lacks the element; a null array gives an empty one.
    The heaviest keys are on every worker and are probed a whole batch at a time, so
    rows stay whole and where they are. Only rows with other elements are written
    once more, and only these elements travel to the rest of ``dim``, where none of
    them is frequent. Rows are numbered in that table, so keys may repeat or be null.
    """
    ship_package(df.sparkSession)
    on_type, value_type = dim.schema[on].dataType, dim.schema[value].dataType
    head, complete = _broadcast_head(dim, on, value, weight, head_rows)
    look = _found_in(head, on_type, value_type)
    cast = F.lit(None).cast(ArrayType(on_type))
    tried = df.select(*keep, *[look(F.coalesce(a.cast(ArrayType(on_type)), cast)).alias(f"_{n}") for n, a in arrays.items()])
    values = [F.col(f"_{n}.values").alias(n) for n in arrays]
    if complete:
        return tried.select(*keep, *values)
    tried = stage_table(tried.withColumn("_row", F.monotonically_increasing_id()), "lookup")
    is_open = reduce(Column.__or__, [F.size(f"_{n}.late") > 0 for n in arrays])
    tagged = [_tagged(f"_{n}.late", i) for i, n in enumerate(arrays)]
    rest = dim.select(F.col(on).alias("on"), F.col(value).alias("value")).hint("shuffle_merge")
    late = (
        tried.where(is_open)
        .select("_row", F.inline(F.concat(*tagged)))
        .join(rest, "on")
        .groupBy("_row")
        .agg(F.collect_list(F.struct("of", "pos", "value")).alias("_late"))
    )
    patch = _patched(value_type)
    mended = tried.join(late, "_row").select(
        *keep, *[patch(F.col(f"_{n}.values"), _of(i)).alias(n) for i, n in enumerate(arrays)]
    )
    whole = tried.join(late.select("_row"), "_row", "left_anti").select(*keep, *values)
    return whole.unionByName(mended)


def with_positions(
    df: DataFrame, order: Sequence[str], within: Sequence[str] = (), descending: Sequence[str] = ()
) -> DataFrame:
    """Number rows from 0 by ``order`` inside each ``within`` group, as column ``pos``.

    A window over the group would sort a hot group in one task. Here a range
    shuffle spreads every group over tasks, the sorted rows are written once
    with their place in their part, and only one row per (group, part) is
    summed up to get the offsets. ``order`` must identify rows in a group; among
    rows it doesn't tell apart, any order is taken. Nulls come first and are a group
    of their own.
    """
    cols = [*within, *order]
    keys = [F.desc(c) if c in descending else F.asc(c) for c in cols]
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    placed = stage_table(placed, "positions")
    part_keys = [*within, "_part"]
    parts = placed.groupBy(*part_keys).agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    earlier = (
        Window.partitionBy(*[F.col(c) for c in within] or [F.lit(0)])
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = parts.select(
        *part_keys,
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    return (
        null_safe_join(placed, offsets, part_keys)
        .withColumn("pos", F.col("_place") + F.col("_shift"))
        .drop("_part", "_place", "_shift")
    )


def running_before(df: DataFrame, within: Sequence[str], value: str, how: str, out: str) -> DataFrame:
    """``how`` (min or max) of ``value`` over all earlier ``pos`` of the group, as ``out``.

    Blocks of positions are aggregated first, so that no task holds more than
    one block of a group plus one row per block.
    """
    agg = {"min": F.min, "max": F.max}[how]
    pick = {"min": F.least, "max": F.greatest}[how]
    blocked = df.withColumn("_block", F.floor(F.col("pos") / BLOCK_ROWS))
    totals = blocked.groupBy(*within, "_block").agg(agg(value).alias("_total"))
    before = Window.partitionBy(*within).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*within, "_block", agg("_total").over(before).alias("_carry"))
    inside = (
        Window.partitionBy(*within, "_block")
        .orderBy("pos")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        null_safe_join(blocked, carried, [*within, "_block"])
        .withColumn(out, pick(agg(value).over(inside), F.col("_carry")))
        .drop("_block", "_carry")
    )
