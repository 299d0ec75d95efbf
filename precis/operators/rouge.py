"""ROUGE-1, -2, -L and -Lsum per pair, corpus means, and bootstrap intervals."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from math import exp, factorial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from precis.functions.lcs import lcs_length, union_hits
from precis.functions.parts import paired_slices, tokens_of
from precis.functions.porter import stem
from precis.session import ship_package

METRICS = ("rouge1", "rouge2", "rougeL", "rougeLsum")
# Scores are averaged as whole millionths, so that sums do not depend on task order.
MICRO = 1_000_000


def gram_hits(refs: pa.Array, preds: pa.Array, n: int) -> pa.Array:
    """For each row how many ``n``-grams its two token lists share, each as often as on the side that has fewer."""
    sides, at, codes = [refs, preds], [], []
    words = pa.concat_arrays([x.flatten() for x in sides]).dictionary_encode()
    word = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n_refs = len(refs.flatten())
    for x, own in zip(sides, (word[:n_refs], word[n_refs:]), strict=True):
        row = np.repeat(np.arange(len(x)), pc.list_value_length(x).to_numpy(zero_copy_only=False))
        # A gram starts where its last token is of the same row.
        starts = np.flatnonzero(row[: len(row) - n + 1] == row[n - 1 :]) if len(row) >= n else np.empty(0, np.int64)
        code = own[starts]
        for i in range(1, n):
            code = code * len(words.dictionary) + own[starts + i]
        at.append(row[starts])
        codes.append(code)
    _, gram = np.unique(np.concatenate(codes), return_inverse=True)
    size = int(gram.max(initial=0)) + 1
    split = len(codes[0])
    counted = [np.unique(r * size + g, return_counts=True) for r, g in zip(at, (gram[:split], gram[split:]), strict=True)]
    _, left, right = np.intersect1d(counted[0][0], counted[1][0], assume_unique=True, return_indices=True)
    hits = np.zeros(len(refs), np.int64)
    np.add.at(hits, counted[0][0][left] // size, np.minimum(counted[0][1][left], counted[1][1][right]))
    return pa.array(hits)


_FOUND = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("n_pred", "n_ref", "rouge1", "rouge2", "rougeL", "rougeLsum")]
)


def _lines_of(codes: list[int], lines: list[int]) -> list[list[int]]:
    """The tokens of one side by line; lines without any share nothing with others."""
    out: dict[int, list[int]] = {}
    for code, line in zip(codes, lines, strict=True):
        out.setdefault(line, []).append(code)
    return list(out.values())


def overlaps(preds: pa.Array, refs: pa.Array, metrics: Sequence[str], stemmed: bool) -> pa.Array:
    """For each row the tokens of either side and the hits of each of ``metrics`` (others: 0), a whole Arrow batch at once."""
    columns: dict[str, list[np.ndarray]] = {f.name: [] for f in _FOUND}
    for texts in paired_slices(preds, refs):
        sides = [tokens_of(*x) for x in texts]
        words = pa.concat_arrays([x.words for x in sides])
        if stemmed:
            words = pa.array([stem(w) if len(w) > 3 else w for w in words.to_pylist()], pa.string())
        code_of = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        n_words = len(sides[0].words)
        codes = [own[x.codes] for x, own in zip(sides, (code_of[:n_words], code_of[n_words:]), strict=True)]
        ends = [np.searchsorted(x.starts, bounds) for x, (_, bounds) in zip(sides, texts, strict=True)]
        lines = [np.cumsum(data == ord("\n"))[x.starts] for x, (data, _) in zip(sides, texts, strict=True)]
        pred, ref = (pa.ListArray.from_arrays(pa.array(e, pa.int32()), pa.array(c)) for e, c in zip(ends, codes, strict=True))
        found = dict.fromkeys(columns, np.zeros(len(pred), np.int64))
        found["n_pred"], found["n_ref"] = (np.diff(e) for e in ends)
        for m, n in (("rouge1", 1), ("rouge2", 2)):
            if m in metrics:
                found[m] = gram_hits(ref, pred, n).to_numpy(zero_copy_only=False)
        if "rougeL" in metrics or "rougeLsum" in metrics:
            longest, union = [], []
            (p, r), (p_line, r_line) = ([x.tolist() for x in y] for y in (codes, lines))
            for a, b, c, d in zip(*(x.tolist() for e in ends for x in (e[:-1], e[1:])), strict=True):
                single = a == b or c == d or (p_line[a] == p_line[b - 1] and r_line[c] == r_line[d - 1])
                lcs = lcs_length(r[c:d], p[a:b]) if single or "rougeL" in metrics else 0
                longest.append(lcs)
                if "rougeLsum" in metrics:
                    # Of one line on either side, the union is its longest common subsequence.
                    union.append(lcs if single else union_hits(_lines_of(r[c:d], r_line[c:d]), _lines_of(p[a:b], p_line[a:b])))
            found |= {m: np.array(x, np.int64) for m, x in (("rougeL", longest), ("rougeLsum", union)) if m in metrics}
        for c, own in columns.items():
            own.append(found[c])
    arrays = [pa.array(np.concatenate([np.empty(0, np.int64), *own]), pa.int64()) for own in columns.values()]
    return pa.StructArray.from_arrays(arrays, names=list(columns))


def _ratio(hits: Column, n: Column) -> Column:
    return F.when(n > 0, hits / n).otherwise(F.lit(0.0))


def prf(hits: Column, n_pred: Column, n_ref: Column) -> tuple[Column, Column, Column]:
    """Precision, recall and F1, each rounded to six digits."""
    f1 = F.when(hits > 0, 2.0 * hits / (n_pred + n_ref)).otherwise(F.lit(0.0))
    return (
        F.round(_ratio(hits, n_pred), 6),
        F.round(_ratio(hits, n_ref), 6),
        F.round(f1, 6),
    )


def rouge_scores(
    df: DataFrame,
    key: Sequence[str],
    pred: str,
    ref: str,
    metrics: Sequence[str] = METRICS,
    keep: Sequence[str] = (),
    stemmed: bool = False,
) -> DataFrame:
    """Overlap of ``pred`` and ``ref`` per row, in long form.

    Returns ``key, keep, metric, hits, n_pred, n_ref, precision, recall, f1``, for
    every row on its own: rows of equal or null key stay apart. A row needs nothing
    of another, so nothing moves: texts are cut into tokens and grams counted for a
    whole Arrow batch at once (see ``overlaps``), subsequences row by row.
    """
    ship_package(df.sparkSession)

    def find(preds: pa.Array, refs: pa.Array) -> pa.Array:
        return overlaps(preds, refs, metrics, stemmed)

    # Marked so that Spark runs it in a step of its own, once a row.
    found = F.arrow_udf(find, _FOUND).asNondeterministic()
    p, r = F.coalesce(pred, F.lit("")), F.coalesce(ref, F.lit(""))
    kept = [F.col(c).alias(f"_kept{i}") for i, c in enumerate(keep)]
    own = [F.col(c).alias(f"_key{i}") for i, c in enumerate(key)]
    scored = df.select(*own, *kept, found(p, r).alias("_found"))

    def less(c: str, n: int) -> Column:
        return F.greatest(F.col(f"_found.{c}") - (n - 1), F.lit(0)).cast("long")

    sizes = {"rouge1": 1, "rouge2": 2, "rougeL": 1, "rougeLsum": 1}
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(f"_found.{m}").alias("hits"),
            less("n_pred", sizes[m]).alias("n_pred"),
            less("n_ref", sizes[m]).alias("n_ref"),
        )
        for m in metrics
    ]
    named = [F.col(f"_key{i}").alias(c) for i, c in enumerate(key)] + [F.col(f"_kept{i}").alias(c) for i, c in enumerate(keep)]
    long = scored.select(*named, F.inline(F.array(*rows)))
    precision, recall, f1 = prf(F.col("hits"), F.col("n_pred"), F.col("n_ref"))
    return long.withColumns({"precision": precision, "recall": recall, "f1": f1})


def micro(c: str) -> Column:
    """A score as whole millionths."""
    return F.round(F.col(c) * MICRO).cast("long")


SUMS = ("precision", "recall", "f1")


def metric_states(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """Partial sums of scores: ``by, n_pairs`` and ``sum_<score>`` in whole millionths.

    States of parts of the data add up exactly to those of the whole, in any order.
    """
    sums = [F.sum(micro(c)).alias(f"sum_{c}") for c in SUMS]
    return scores.groupBy(*by).agg(F.count(F.lit(1)).alias("n_pairs"), *sums)


def merge_states(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """The states of several batches as one for each group."""
    return states.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("n_pairs", *(f"sum_{c}" for c in SUMS))])


def state_means(states: DataFrame, by: Sequence[str], digits: int = 6) -> DataFrame:
    """Mean precision, recall and F1 of each state; a state without pairs has none."""
    n = F.col("n_pairs") * F.lit(float(MICRO))
    means = [F.round(F.try_divide(F.col(f"sum_{c}").cast("double"), n), digits).alias(c) for c in SUMS]
    return states.select(*by, "n_pairs", *means)


def corpus_scores(scores: DataFrame, by: Sequence[str], digits: int = 6) -> DataFrame:
    """Mean precision, recall and F1 per group; partial sums are exact integers."""
    return state_means(metric_states(scores, by), by, digits)


class MetricTable:
    """States of scores by batch below one folder: add batches as they come, compute the means of all so far.

    A batch has a name and one folder; adding it again replaces it, so a repeated
    batch counts once. Batches may be added by different applications.
    """

    def __init__(self, path: str, by: Sequence[str]):
        self.path, self.by = path.rstrip("/"), tuple(by)

    def add_batch(self, scores: DataFrame, batch: str) -> None:
        metric_states(scores, self.by).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def states(self, spark: SparkSession) -> DataFrame:
        return spark.read.option("basePath", self.path).parquet(f"{self.path}/batch=*")

    def compute(self, spark: SparkSession, digits: int = 6) -> DataFrame:
        return state_means(merge_states(self.states(spark), self.by), self.by, digits)


# P(X <= k) of the Poisson distribution with mean 1, as thresholds for 32-bit draws in hex.
POISSON_EDGES = tuple(
    f"{round(2**32 * sum(exp(-1) / factorial(i) for i in range(k + 1))):08x}" for k in range(12)
)


# Tasks' sums meet in so many lanes first, so that no task merges those of all others.
_LANES = 64


def poisson_weights(keys: Sequence[str | None], replicates: int) -> np.ndarray:
    """A row's Poisson(1) weight in each replicate: four replicates to the MD5 of key and number."""
    edges = np.array([int(e, 16) for e in POISSON_EDGES], dtype=np.uint64)
    fours = [str(i).encode() for i in range((replicates + 3) // 4)]
    digests = bytearray()
    for key in keys:
        start = b"" if key is None else f"{key}:".encode()
        for four in fours:
            digests += hashlib.md5(start + four).digest()
    draws = np.frombuffer(digests, dtype=">u4").reshape(len(keys), -1)[:, :replicates]
    return np.searchsorted(edges, draws.astype(np.uint64), side="right").astype(np.int64)


def _interval(means: np.ndarray) -> list[float]:
    """The 2.5, 50 and 97.5 % quantiles, by linear interpolation."""
    means = np.sort(means)
    out = []
    for q in (0.025, 0.5, 0.975):
        at = q * (len(means) - 1)
        low, high = int(np.floor(at)), int(np.ceil(at))
        out.append(float(means[low]) if low == high else float((high - at) * means[low] + (at - low) * means[high]))
    return out


def bootstrap_interval(
    scores: DataFrame,
    key: str,
    by: Sequence[str],
    metrics: Sequence[str] = METRICS,
    replicates: int = 1000,
) -> DataFrame:
    """Low, mid and high (2.5, 50, 97.5 %) of the resampled mean F1 per group and metric.

    Poisson resampling needs no draw across rows: a row's weight in a replicate
    comes from the MD5 of its key and the replicate number, four replicates per
    digest, and is the same on every run; rows of one key share it, a null key is an
    empty one. Each task folds its rows into one vector of ``replicates`` sums per
    group and metric, and only these vectors are shuffled and added up.
    """
    ship_package(scores.sparkSession)
    groups = [*by, "metric"]
    fields = {c: scores.schema[c].dataType.simpleString() for c in groups}
    schema = ", ".join(f"`{c}` {kind}" for c, kind in fields.items()) + ", lane int, n array<long>, total array<long>"

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
        kinds: list[pa.Field] = []
        for batch in batches:
            kinds = [batch.schema.field(i) for i in range(len(groups))]
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                named = part.column(len(groups)).dictionary_encode()
                row_key = pc.fill_null(named.indices, len(named.dictionary)).to_numpy(zero_copy_only=False)
                weights = poisson_weights([*named.dictionary.to_pylist(), None], replicates)
                value = part.column(len(groups) + 1).to_numpy(zero_copy_only=False)
                rows: dict[tuple, list[int]] = {}
                for i, group in enumerate(zip(*(part.column(j).to_pylist() for j in range(len(groups))), strict=True)):
                    rows.setdefault(group, []).append(i)
                for group, own in rows.items():
                    w = weights[row_key[own]]
                    n, total = sums.setdefault(group, (np.zeros(replicates, np.int64), np.zeros(replicates, np.int64)))
                    n += w.sum(axis=0)
                    total += value[own] @ w
        lane = TaskContext.get().partitionId() % _LANES
        longs = pa.list_(pa.int64())
        out = pa.schema([*kinds, ("lane", pa.int32()), ("n", longs), ("total", longs)])
        for group, (n, total) in sums.items():
            row = dict(zip(groups, group, strict=True)) | {"lane": lane, "n": n, "total": total}
            yield pa.RecordBatch.from_pylist([row], schema=out)

    def merged(parts: pd.DataFrame) -> pd.DataFrame:
        row = parts.iloc[[0]].copy()
        for c in ("n", "total"):
            row[c] = [np.sum(np.stack(parts[c].to_list()), axis=0)]
        return row

    def quantiles(parts: pd.DataFrame) -> pd.DataFrame:
        row = merged(parts)
        n, total = row["n"].iloc[0], row["total"].iloc[0]
        low, mid, high = _interval(total[n > 0] / (n[n > 0] * float(MICRO))) if (n > 0).any() else [None] * 3
        return row[groups].assign(low=low, mid=mid, high=high)

    chosen = scores.where(F.col("metric").isin(list(metrics)))
    chosen = chosen.select(*groups, F.col(key).cast("string").alias("_key"), micro("f1").alias("_f1")).where("_f1 is not null")
    states = chosen.mapInArrow(fold, schema)
    lanes = states.groupBy(*groups, "lane").applyInPandas(merged, schema)
    ends = ", ".join(f"`{c}` {kind}" for c, kind in fields.items()) + ", low double, mid double, high double"
    found = lanes.groupBy(*groups).applyInPandas(quantiles, ends)
    return found.select(*groups, *[F.round(c, 6).alias(c) for c in ("low", "mid", "high")])
