"""A sentence scorer trained with ``pyspark.ml``, chosen by validation loss."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from precis.functions.text import sentences, tokens
from precis.operators.summarize import MIN_CHARS, MIN_COUNT
from precis.session import path_exists, ship_package, stage_table

FEATURES = ("place", "place_share", "n_words", "frequency", "frequency_share")
GRID = (0.0, 0.01, 0.1)
MAX_ITER = 100
# A full F1 in the whole numbers that the choice of labels compares.
FULL = 1_000_000

_FACTS = T.ArrayType(
    T.StructType(
        [
            T.StructField(c, T.LongType())
            for c in ("n_words", "n_distinct", "n_ref", "shared", "frequency", "top", "last", "pick", "score")
        ]
    )
)


def greedy_choice(sents: Sequence[Sequence[str]], ref: Sequence[str]) -> list[tuple[int, int]]:
    """``(sentence, score)`` in the order of choice (Nallapati et al. 2017).

    While the score grows, the sentence that raises it most is added, the earliest of
    equals. The score of a choice is ROUGE-1 plus ROUGE-2 F1 against the reference, each
    in whole millionths; pairs of words don't cross sentences.
    """
    places, grams, counts, sizes, hits = [], [], [], [], []
    left, n_ref = [], []
    for n in (1, 2):
        grams_of = (lambda x: x) if n == 1 else (lambda x: list(zip(x, x[1:], strict=False)))
        number: dict[str | tuple[str, str], int] = {}
        wanted: list[int] = []
        for gram in grams_of(ref):
            at = number.setdefault(gram, len(number))
            wanted.extend([0] * (at + 1 - len(wanted)))
            wanted[at] += 1
        found = [(s, at) for s, x in enumerate(sents) for g in grams_of(x) if (at := number.get(g)) is not None]
        known = np.array(found, dtype=np.int64).reshape(-1, 2)
        code, times = np.unique(known[:, 0] * max(len(number), 1) + known[:, 1], return_counts=True)
        places.append(code // max(len(number), 1))
        grams.append(code % max(len(number), 1))
        counts.append(times)
        sizes.append(np.array([max(len(x) - n + 1, 0) for x in sents], dtype=np.int64))
        left.append(np.array(wanted, dtype=np.int64))
        n_ref.append(sum(wanted))
        hits.append(0)
    taken, free = [0, 0], np.ones(len(sents), dtype=bool)
    chosen: list[tuple[int, int]] = []
    best = 0
    while free.any():
        total = np.zeros(len(sents), dtype=np.int64)
        for k in range(2):
            more = np.minimum(counts[k], left[k][grams[k]])
            gain = np.bincount(places[k], weights=more, minlength=len(sents)).astype(np.int64)
            total += 2 * FULL * (hits[k] + gain) // np.maximum(taken[k] + sizes[k] + n_ref[k], 1)
        total[~free] = -1
        at = int(np.argmax(total))
        if total[at] <= best:
            break
        best = int(total[at])
        chosen.append((at, best))
        free[at] = False
        for k in range(2):
            own = places[k] == at
            more = np.minimum(counts[k][own], left[k][grams[k][own]])
            left[k][grams[k][own]] -= more
            hits[k] += int(more.sum())
            taken[k] += int(sizes[k][at])
    return chosen


def _facts(texts: pa.Array, references: pa.Array) -> pa.Array:
    """What the features and labels of each sentence need, from the words of a text and its reference."""
    columns: dict[str, list[int]] = {f.name: [] for f in _FACTS.elementType}
    ends = [0]
    for sents, ref in zip(texts.to_pylist(), references.to_pylist(), strict=True):
        n, wanted = len(sents), set(ref)
        counts = Counter(chain.from_iterable(sents))
        frequent = {w: c for w, c in counts.items() if c >= MIN_COUNT and len(w) >= MIN_CHARS}
        picks = {s: (i + 1, score) for i, (s, score) in enumerate(greedy_choice(sents, ref))} if ref else {}
        distinct = [set(x) for x in sents]
        frequency = [sum([frequent[w] for w in own if w in frequent]) for own in distinct]
        columns["n_words"] += map(len, sents)
        columns["n_distinct"] += map(len, distinct)
        columns["n_ref"] += [len(wanted)] * n
        columns["shared"] += [len(own & wanted) for own in distinct]
        columns["frequency"] += frequency
        columns["top"] += [max([1, *frequency])] * n
        columns["last"] += [max(n - 1, 1)] * n
        columns["pick"] += [picks[i][0] if i in picks else 0 for i in range(n)]
        columns["score"] += [picks[i][1] if i in picks else 0 for i in range(n)]
        ends.append(ends[-1] + n)
    rows = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns.values()], names=list(columns))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)


# Marked so that Spark neither copies it into filters that it infers nor runs it once for each field.
_sentence_facts = F.arrow_udf(_facts, _FACTS).asNondeterministic()


def sentence_rows(df: DataFrame, text: str, reference: str | None = None) -> DataFrame:
    """All columns of ``df`` and ``_sents``: an array with sentence, features, overlap, pick and label of each.

    ``pick`` is the place of a sentence in the greedy choice against the reference (0:
    not chosen), ``label`` whether it was chosen. A row keeps to itself: no shuffle,
    and nulls, repeated keys and repeated rows change nothing. Without sentences the
    array is empty.
    """
    ship_package(df.sparkSession)
    ref = F.coalesce(F.col(reference), F.lit("")) if reference else F.lit("")
    split = df.withColumn("_text", F.coalesce(sentences(F.col(text)), F.array().cast("array<string>")))
    facts = _sentence_facts(F.transform("_text", tokens), tokens(ref))

    # Whatever a sentence needs of its whole text comes with its facts: in here it would be found anew for each sentence.
    def row(sentence: Column, x: Column) -> Column:
        overlap = F.try_divide(2.0 * x["shared"], x["n_distinct"] + x["n_ref"])
        return F.struct(
            sentence["sent"].alias("sent"),
            sentence["sentence"].alias("sentence"),
            sentence["sent"].cast("double").alias("place"),
            (sentence["sent"] / x["last"]).alias("place_share"),
            x["n_words"].cast("double").alias("n_words"),
            x["frequency"].cast("double").alias("frequency"),
            (x["frequency"] / x["top"]).alias("frequency_share"),
            F.coalesce(F.round(overlap, 6), F.lit(0.0)).alias("overlap"),
            x["pick"].cast("int").alias("pick"),
            x["score"].alias("score"),
            (x["pick"] > 0).cast("double").alias("label"),
        )

    numbered = F.transform("_text", lambda s, i: F.struct(i.alias("sent"), s.alias("sentence")))
    return split.withColumn("_facts", facts).withColumn("_sents", F.zip_with(numbered, "_facts", row)).drop("_text", "_facts")


def sentence_features(
    df: DataFrame, key: str, text: str, reference: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per sentence with ``FEATURES``, ``overlap``, ``pick`` and ``label`` (see ``sentence_rows``)."""
    rows = sentence_rows(df.select(key, *keep, *{text, *([reference] if reference else [])} - {key, *keep}), text, reference)
    return rows.select(key, *keep, F.inline("_sents")).drop("score")


def oracle_labels(df: DataFrame, key: str, text: str, reference: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(key, keep, pick, sent, score)``: the sentences of the greedy choice, and the score with each of them."""
    rows = sentence_rows(df.select(key, *keep, *{text, reference} - {key, *keep}), text, reference)
    chosen = F.filter("_sents", lambda x: x["pick"] > 0)
    return rows.select(key, *keep, F.inline(chosen)).select(key, *keep, "pick", "sent", "score")


def probability(model: PipelineModel, features: DataFrame) -> DataFrame:
    scored = model.transform(features)
    return scored.withColumn("p", vector_to_array("probability")[1])


def log_loss(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Mean negative log-likelihood per split."""
    p = F.greatest(F.least(F.col("p"), F.lit(1 - 1e-12)), F.lit(1e-12))
    loss = F.when(F.col("label") == 1.0, -F.log(p)).otherwise(-F.log(1 - p))
    return probability(model, features).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_sentences"), F.round(F.avg(loss), 6).alias("log_loss")
    )


def train_sentence_model(
    features: DataFrame, grid: Sequence[float] = GRID, max_iter: int = MAX_ITER
) -> tuple[PipelineModel, DataFrame]:
    """Fit on train, choose the regularisation by validation loss, report all splits.

    Returns the chosen model and ``(reg_param, split, n_sentences, log_loss, chosen,
    converged)``; a fit that used up ``max_iter`` steps has not converged.
    """
    spark = features.sparkSession
    features = stage_table(features.select("split", "label", *FEATURES), "features")
    train = features.where(F.col("split") == "train")
    prepare = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(FEATURES), outputCol="raw"),
            StandardScaler(inputCol="raw", outputCol="features", withMean=True),
        ]
    ).fit(train)
    prepared = prepare.transform(train).select("features", "label").persist(StorageLevel.MEMORY_AND_DISK)
    tried = []
    for reg in grid:
        fitted = LogisticRegression(regParam=reg, maxIter=max_iter, standardization=False).fit(prepared)
        converged = fitted.summary.totalIterations < max_iter
        model = PipelineModel([*prepare.stages, fitted])
        # One row per split comes back to the driver.
        losses = log_loss(model, features).collect()
        tried += [(model, reg, r.split, r.n_sentences, r.log_loss, converged) for r in losses]
    prepared.unpersist()
    validated = [t for t in tried if t[2] == "validation"] or tried
    best = min(validated, key=lambda t: (t[4], t[1]))
    rows = [(reg, split, n, loss, reg == best[1], done) for _, reg, split, n, loss, done in tried]
    schema = "reg_param double, split string, n_sentences long, log_loss double, chosen boolean, converged boolean"
    return best[0], spark.createDataFrame(rows, schema)


def save_model(model: PipelineModel, path: str) -> None:
    """Write a model with all of its steps below one folder."""
    model.write().overwrite().save(f"{path}/model")


def load_model(spark: SparkSession, candidates: Sequence[str]) -> PipelineModel | None:
    """The first saved model in the list of folders; None when there is none."""
    for path in candidates:
        if path_exists(spark, f"{path}/model/metadata"):
            return PipelineModel.load(f"{path}/model")
    return None
