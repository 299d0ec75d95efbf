"""Extractive summaries: lead, word frequency, TF-IDF and graph rank.

Scores are whole numbers, so a ranking never depends on the order in which
tasks add up. Each scorer moves the texts once, by key; sentences and words are
then counted, ranked and put together inside the tasks. Columns to keep ride on
one marker row per text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from precis.functions.parts import Parts, choose, distinct, numbered, parts_of, slices, tokens_of, word_hashes
from precis.functions.text import cut_words, let, ngrams, sentences, tokens, words
from precis.operators.skew import lookup_arrays
from precis.session import ship_package, stage_table

MAX_WORDS = 128
NO_REPEAT = 5
# A word counts for a sentence when it is this long and this frequent in its text.
MIN_CHARS, MIN_COUNT = 4, 2
# Graph rank: rounds, damping in percent, and the scales of ranks and weights.
ROUNDS, DAMPING = 5, 85
RANK_ONE, WEIGHT_ONE, FLOW_ONE = 1_000_000, 1_000, 1_000
# TF-IDF weights of at most so many words are on every worker, in 12 bytes each at most (10 as a rule), 192 MB at worst.
HEAD_WORDS = 16_000_000
# Words are counted in runs of so many bytes of text.
RUN_BYTES = 64_000_000
# Choices that a beam search holds, and its length penalty.
BEAMS, PENALTY = 8, 0.8
RANK_BASE = (100 - DAMPING) * RANK_ONE // 100

# Words of a summary: one number, or a column with one for each text.
Budget = int | Column


def choose_sentences(ranked: Column, max_words: Budget, no_repeat: int = NO_REPEAT) -> Column:
    """Walk the ranked sentences and keep what fits, in text order.

    ``ranked`` is a sorted array of structs with ``sent`` and ``sentence``. A
    sentence counts as its first ``max_words`` words. It is skipped when the
    budget would be exceeded or when it shares an ``no_repeat``-gram with a kept one.
    """
    start = F.expr(
        "named_struct('n', 0, 'kept', cast(array() as array<struct<sent:int,text:string>>),"
        " 'grams', cast(array() as array<string>))"
    )

    def take(state: Column, item: Column) -> Column:
        def unless_repeated(grams: Column) -> Column:
            kept = F.struct(item.sent.alias("sent"), item.text.alias("text"))
            extended = F.struct(
                (state.n + item.n).alias("n"),
                F.concat(state.kept, F.array(kept)).alias("kept"),
                F.concat(state.grams, grams).alias("grams"),
            )
            return F.when(~F.arrays_overlap(state.grams, grams), extended).otherwise(state)

        grams = ngrams(tokens(item.text), no_repeat)
        return F.when(state.n + item.n <= max_words, let(grams, unless_repeated)).otherwise(state)

    items = F.transform(
        ranked,
        lambda x: F.struct(
            x.sent.alias("sent"),
            cut_words(x.sentence, max_words).alias("text"),
            F.least(F.size(words(x.sentence)), F.lit(max_words)).alias("n"),
        ),
    )
    return F.aggregate(
        items,
        start,
        take,
        lambda state: F.array_join(F.transform(F.array_sort(state.kept), lambda k: k.text), " "),
    )


class _Beam(NamedTuple):
    """A choice among the sentences seen so far; ``path`` has a 1 for each taken, a 0 for each left out."""

    total: int
    path: str
    words: int
    grams: frozenset[str]
    greedy: bool


def beam_search(
    sizes: Sequence[int], scores: Sequence[int], grams: Sequence[Sequence[str]], max_words: int, width: int, penalty: float
) -> list[int]:
    """Places of the sentences of the best choice that a search of bounded width finds, in ascending order.

    Sentences come by rank, and every choice held goes on both with the next one, if it
    fits the words and repeats no gram, and without it. The ``width`` choices of the
    highest total score stay (of equals the one that took earlier), and always the greedy
    one, which takes whatever fits. In the end the total per ``words ** penalty`` decides,
    to six digits, so no result is worse than the greedy choice.
    """
    beams = [_Beam(0, "", 0, frozenset(), True)]
    for size, score, own in zip(sizes, scores, grams, strict=True):
        onward = []
        for b in beams:
            able = b.words + size <= max_words and b.grams.isdisjoint(own)
            if able:
                onward.append(_Beam(b.total + score, b.path + "1", b.words + size, b.grams.union(own), b.greedy))
            onward.append(b._replace(path=b.path + "0", greedy=b.greedy and not able))
        onward.sort(key=lambda b: (b.total, b.path), reverse=True)
        beams = onward[:width] + [b for b in onward[width:] if b.greedy]
    best = max(beams, key=lambda b: (round(b.total / max(b.words, 1) ** penalty, 6), b.path))
    return [i for i, taken in enumerate(best.path) if taken == "1"]


def _chosen(ranked: DataFrame, keep: Sequence[str], beams: int) -> DataFrame:
    """``keep`` and ``prediction`` from ``_ranked`` sentences and the ``_budget`` of each text."""
    if beams == 1:
        return ranked.select(*keep, choose_sentences(F.col("_ranked"), F.col("_budget")).alias("prediction"))
    budget = F.col("_budget")
    items = F.transform(
        "_ranked",
        lambda x: F.struct(
            x.sent.alias("sent"),
            cut_words(x.sentence, budget).alias("text"),
            F.least(F.size(words(x.sentence)), budget).alias("n"),
            (-x.order).alias("score"),
        ),
    )
    listed = ranked.select(*keep, "_budget", items.alias("_items")).select(
        "*",
        F.transform("_items", lambda x: x.n).alias("_sizes"),
        F.transform("_items", lambda x: x.score).alias("_scores"),
        F.transform("_items", lambda x: ngrams(tokens(x.text), NO_REPEAT)).alias("_grams"),
    )
    asked = [listed.columns.index(c) for c in ("_sizes", "_scores", "_grams", "_budget")]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in asked), strict=True)
            places = pa.array([beam_search(*row, beams, PENALTY) for row in rows], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, places], names=[*batch.schema.names, "_places"])

    schema = T.StructType([*listed.schema.fields, T.StructField("_places", T.ArrayType(T.IntegerType()))])
    kept = F.transform("_places", lambda i: F.get("_items", i))
    text = F.array_join(F.transform(F.array_sort(kept), lambda x: x.text), " ")
    return listed.mapInArrow(search, schema).select(*keep, text.alias("prediction"))


def _picked(score: Callable[[Parts], np.ndarray]) -> Callable[[Column, Column], Column]:
    """A function on texts and budgets: what the greedy walk keeps of the sentences by their scores.

    Texts are cut, scored and put together again inside one step, so that neither
    sentences nor tokens travel between Spark and Python.
    """

    def pick(texts: pa.Array, budgets: pa.Array) -> pa.Array:
        limits, out = budgets.to_pylist(), []
        for row, data, bounds in slices(texts):
            parts = parts_of(data, bounds)
            out += choose(parts, score(parts), limits[row : row + len(bounds) - 1], NO_REPEAT)
        return pa.array(out, pa.binary()).view(pa.string())

    # Marked so that Spark runs it in a step of its own, once a row.
    return F.arrow_udf(pick, T.StringType()).asNondeterministic()


def lead(c: Column, k: int, max_words: Budget) -> Column:
    """The first ``k`` sentences, cut after ``max_words`` words."""
    first = F.array_join(F.slice(sentences(c), 1, k), " ")
    return let(first, lambda text: cut_words(text, max_words))


def summarize_lead(
    df: DataFrame, key: str, text: str, keep: Sequence[str] = (), k: int = 3, max_words: Budget = MAX_WORDS
) -> DataFrame:
    """Lead baseline: a projection, without any shuffle."""
    return df.select(key, *keep, lead(F.col(text), k, max_words).alias("prediction"))


def frequency_scores(texts: pa.Array) -> pa.Array:
    """Scores of the sentences of each text by the text's own frequent words (Luhn 1958).

    ``texts`` holds, per text, the longer words of every sentence. A sentence scores
    the sum, over its distinct frequent words, of their counts in the text. Counts
    are local to a text, so a whole Arrow batch is scored at once.
    """
    sents = texts.flatten()
    n_sents = pc.list_value_length(texts).to_numpy(zero_copy_only=False)
    sent_of = np.repeat(np.arange(len(sents)), pc.list_value_length(sents).to_numpy(zero_copy_only=False))
    text_of = np.repeat(np.arange(len(texts)), n_sents)[sent_of]
    words = sents.flatten().dictionary_encode()
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = len(words.dictionary) + 1
    word_of, _ = numbered(text_of * size + codes)
    counts = np.bincount(word_of)
    pairs = distinct(sent_of * (len(counts) + 1) + word_of)
    sent, count = pairs // (len(counts) + 1), counts[pairs % (len(counts) + 1)] if len(pairs) else pairs
    scores = np.zeros(len(sents), dtype=np.int64)
    np.add.at(scores, sent, np.where(count >= MIN_COUNT, count, 0))
    ends = np.concatenate([[0], np.cumsum(n_sents)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(scores, pa.int64()))


# Scorers are marked so that Spark runs each in a step of its own, before what takes its scores.
_frequency_scores = F.arrow_udf(frequency_scores, T.ArrayType(T.LongType())).asNondeterministic()


def _scored_in_place(
    df: DataFrame,
    key: str,
    text: str,
    keep: Sequence[str],
    max_words: Budget,
    scorer: Callable,
    terms: Callable,
    score: Callable[[Parts], np.ndarray],
    beams: int = 1,
) -> DataFrame:
    """Summaries by a scorer that needs nothing but the text: a projection, without any shuffle.

    ``score`` gives for the sentences of a slice what ``scorer`` gives for their ``terms``.
    """
    ship_package(df.sparkSession)
    if beams == 1:
        budget = F.lit(max_words).cast("int")
        return df.select(key, *keep, _picked(score)(F.col(text), budget).alias("prediction"))
    split = df.select(key, *keep, F.lit(max_words).alias("_budget"), sentences(F.col(text)).alias("_sents"))
    ranked = F.zip_with(
        F.transform("_sents", lambda s, i: F.struct(i.alias("sent"), s.alias("sentence"))),
        "_scores",
        lambda s, score: F.struct((-score).alias("order"), s.sent.alias("sent"), s.sentence.alias("sentence")),
    )
    scored = split.withColumn("_scores", scorer(F.transform("_sents", terms)))
    return _chosen(scored.select(key, *keep, "_budget", F.array_sort(ranked).alias("_ranked")), [key, *keep], beams)


def _by_frequency(parts: Parts) -> np.ndarray:
    long = pc.utf8_length(parts.tokens.words).to_numpy(zero_copy_only=False) >= MIN_CHARS
    long = long[parts.tokens.codes]
    first_token = np.concatenate([[0], np.cumsum(long)])[parts.first_token]
    texts = parts.nested(parts.tokens.codes[long], first_token)
    return frequency_scores(texts).flatten().to_numpy(zero_copy_only=False)


def summarize_frequency(
    df: DataFrame, key: str, text: str, keep: Sequence[str] = (), max_words: Budget = MAX_WORDS, beams: int = 1
) -> DataFrame:
    """Sentences rich in the text's own frequent words (see ``frequency_scores``)."""

    def terms(sentence: Column) -> Column:
        return F.filter(tokens(sentence), lambda w: F.length(w) >= MIN_CHARS)

    return _scored_in_place(df, key, text, keep, max_words, _frequency_scores, terms, _by_frequency, beams)


def fit_idf(df: DataFrame, text: str) -> DataFrame:
    """``(word, df, idf)`` over the texts of ``df``; ``idf`` in whole thousandths.

    ``idf = ln((1 + texts) / (1 + df))``. The number of texts is one broadcast row.
    Each task counts runs of texts as they come, so only distinct words leave it.
    """
    ship_package(df.sparkSession)

    def counted(found: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        by_word = pa.concat_tables(found).group_by("word").aggregate([("df", "sum")])
        yield from by_word.rename_columns({"df_sum": "df"}).select(["word", "df"]).to_batches()

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for batch in batches:
            for _, data, bounds in slices(batch.column(0)):
                toks = tokens_of(data, bounds)
                row = np.repeat(np.arange(len(bounds) - 1), np.diff(np.searchsorted(toks.starts, bounds)))
                n_words = max(len(toks.words), 1)
                once = distinct(row * n_words + toks.codes) % n_words
                texts = np.bincount(once, minlength=len(toks.words))
                found.append(pa.table({"word": toks.words, "df": pa.array(texts, pa.int64())}))
                size += len(data)
                if size >= RUN_BYTES:
                    yield from counted(found)
                    found, size = [], 0
        if found:
            yield from counted(found)

    total = df.agg(F.count(F.lit(1)).alias("texts"))
    partial = df.select(F.col(text).alias("word")).mapInArrow(runs, "word string, df long")
    by_word = partial.groupBy("word").agg(F.coalesce(F.sum("df"), F.lit(0)).alias("df"))
    return (
        by_word.withColumn("_one", F.lit(1))
        .join(F.broadcast(total.withColumn("_one", F.lit(1))), "_one")
        .select(
            "word",
            "df",
            F.round(1000 * F.log((1.0 + F.col("texts")) / (1.0 + F.col("df")))).cast("long").alias("idf"),
        )
    )


def weight_sums(texts: pa.Array, weights: pa.Array) -> pa.Array:
    """For each sentence the sum, over its distinct words, of count in the text times weight.

    ``texts`` holds, per text, the words of every sentence, ``weights`` the weights of
    all these words one after another (null: 0). A whole Arrow batch is summed at once.
    """
    sents = texts.flatten()
    n_sents = pc.list_value_length(texts).to_numpy(zero_copy_only=False)
    sent_of = np.repeat(np.arange(len(sents)), pc.list_value_length(sents).to_numpy(zero_copy_only=False))
    text_of = np.repeat(np.arange(len(texts)), n_sents)[sent_of]
    words = sents.flatten().dictionary_encode()
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    weight = pc.fill_null(weights.flatten(), 0).to_numpy(zero_copy_only=False)
    word_of, _ = numbered(text_of * (len(words.dictionary) + 1) + codes)
    counts = np.bincount(word_of)
    _, first = numbered(sent_of * (len(counts) + 1) + word_of)
    sums = np.zeros(len(sents), dtype=np.int64)
    np.add.at(sums, sent_of[first], counts[word_of[first]] * weight[first])
    ends = np.concatenate([[0], np.cumsum(n_sents)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(sums, pa.int64()))


def _weights(idf: DataFrame) -> Broadcast | None:
    """Sorted hashes of all words and their ``idf``, on every worker.

    None when they are more than ``HEAD_WORDS``, or when two of them have one hash.
    """
    spark = idf.sparkSession
    ship_package(spark)
    known = idf.where("word is not null").select("word", "idf")
    n_words, low, high = known.agg(F.count(F.lit(1)), F.min("idf"), F.max("idf")).first()
    if n_words > HEAD_WORDS:
        return None
    kind = "int" if n_words and (low < -(1 << 15) or high >= 1 << 15) else "short"

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(word_hashes(batch.column(0)).view(np.int64))
            yield pa.RecordBatch.from_arrays([found, batch.column(1)], names=["hash", "idf"])

    found = known.withColumn("idf", F.col("idf").cast(kind)).mapInArrow(hashes, f"hash long, idf {kind}").toArrow()
    hashed, idf_of = (found.column(c).to_numpy() for c in ("hash", "idf"))
    by_hash = np.argsort(hashed.view(np.uint64), kind="stable")
    hashed, idf_of = hashed.view(np.uint64)[by_hash], idf_of[by_hash]
    if (hashed[1:] == hashed[:-1]).any():
        return None
    return spark.sparkContext.broadcast((hashed, idf_of))


def _by_weight(head: Broadcast) -> Callable[[Parts], np.ndarray]:
    def score(parts: Parts) -> np.ndarray:
        hashed, idf_of = head.value
        asked = word_hashes(parts.tokens.words)
        at = np.minimum(np.searchsorted(hashed, asked), max(len(hashed) - 1, 0))
        weight = np.where(hashed[at] == asked, idf_of[at], 0) if len(hashed) else np.zeros(len(asked))
        weight = weight.astype(np.int64)[parts.tokens.codes]
        sums = weight_sums(parts.nested(parts.tokens.codes, parts.first_token), pa.array([weight], pa.list_(pa.int64())))
        return np.floor(sums.flatten().to_numpy(zero_copy_only=False) / parts.n_words).astype(np.int64)

    return score


_weight_sums = F.arrow_udf(weight_sums, T.ArrayType(T.LongType())).asNondeterministic()


def summarize_tfidf(
    df: DataFrame,
    idf: DataFrame,
    key: str,
    text: str,
    keep: Sequence[str] = (),
    max_words: Budget = MAX_WORDS,
    beams: int = 1,
) -> DataFrame:
    """Sentences closest to the TF-IDF weight of the whole text.

    A sentence scores the sum of count-in-text times ``idf`` over its distinct
    words, per word of the sentence. Words unseen when ``idf`` was fitted count 0.
    Every row has its summary, whether its key repeats or is null. Weights of up to
    ``HEAD_WORDS`` words are on every worker, by 64-bit hash (a word that was never
    fitted has the hash of one that was with a chance of one in 10**12), and nothing
    moves; of more words the frequent ones are, and texts with others move.
    """
    kept = [key, *keep]
    head = _weights(idf) if beams == 1 else None
    if head is not None:
        ship_package(df.sparkSession)
        budget = F.lit(max_words).cast("int")
        return df.select(*kept, _picked(_by_weight(head))(F.col(text), budget).alias("prediction"))
    split = df.select(*kept, F.lit(max_words).alias("_budget"), sentences(F.col(text)).alias("_sents"))

    def terms() -> Column:
        return F.transform("_sents", tokens)

    weighted = lookup_arrays(
        split, [*kept, "_budget", "_sents"], {"_idf": F.flatten(terms())}, idf, "word", "idf", weight="df"
    )
    ranked = F.zip_with(
        F.transform("_sents", lambda s, i: F.struct(i.alias("sent"), s.alias("sentence"))),
        "_sums",
        lambda s, total: F.struct(
            (-F.floor(total / F.size(words(s.sentence)))).alias("order"),
            s.sent.alias("sent"),
            s.sentence.alias("sentence"),
        ),
    )
    summed = weighted.withColumn("_sums", _weight_sums(terms(), F.col("_idf")))
    return _chosen(summed.select(*kept, "_budget", F.array_sort(ranked).alias("_ranked")), kept, beams)


def graph_ranks(texts: pa.Array) -> pa.Array:
    """Graph rank (Mihalcea & Tarau 2004) of the sentences of each text.

    ``texts`` holds, per text, the distinct words of every sentence. Two sentences
    are tied by the cosine of their word sets. Because that weight is a sum over
    shared words, a round passes rank from sentences to words and back, and no
    pair of sentences is ever formed. A whole Arrow batch is ranked at once. All
    numbers are whole: ranks in millionths, weights in thousandths.
    """
    sents = texts.flatten()
    n_sents = pc.list_value_length(texts).to_numpy(zero_copy_only=False)
    n_words = pc.list_value_length(sents).to_numpy(zero_copy_only=False)
    sent_of = np.repeat(np.arange(len(sents)), n_words)
    text_of = np.repeat(np.arange(len(texts)), n_sents)[sent_of]
    words = sents.flatten().dictionary_encode()
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    word_of, first = numbered(text_of * (len(words.dictionary) + 1) + codes)
    sent_ends = np.cumsum(n_words)

    def by_word(values: np.ndarray) -> np.ndarray:
        if values.sum() < 2**53:  # whole numbers that doubles hold, sums included
            return np.bincount(word_of, weights=values, minlength=len(first)).astype(np.int64)
        sums = np.zeros(len(first), np.int64)
        np.add.at(sums, word_of, values)
        return sums

    def shared(per_sent: np.ndarray) -> np.ndarray:
        """Sum, over the words of a sentence, of the other sentences' values."""
        values = per_sent[sent_of]
        running = np.concatenate([[0], np.cumsum(by_word(values)[word_of] - values)])
        return np.diff(running[sent_ends], prepend=0)

    a = np.floor(WEIGHT_ONE / np.sqrt(np.maximum(n_words, 1))).astype(np.int64)
    degree = a * shared(a)
    score = np.full(len(sents), RANK_ONE, np.int64)
    for _ in range(ROUNDS):
        flow = np.where(degree > 0, score * a * FLOW_ONE // np.maximum(degree, 1), 0)
        score = RANK_BASE + DAMPING * (a * shared(flow) // FLOW_ONE) // 100
    ends = np.concatenate([[0], np.cumsum(n_sents)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(score, pa.int64()))


_graph_ranks = F.arrow_udf(graph_ranks, T.ArrayType(T.LongType())).asNondeterministic()


def _by_rank(parts: Parts) -> np.ndarray:
    sent_of = np.repeat(np.arange(len(parts.starts)), np.diff(parts.first_token))
    size = max(len(parts.tokens.words), 1)
    once = distinct(sent_of * size + parts.tokens.codes)
    first_token = np.searchsorted(once // size, np.arange(len(parts.starts) + 1))
    return graph_ranks(parts.nested(once % size, first_token)).flatten().to_numpy(zero_copy_only=False)


def summarize_textrank(
    df: DataFrame, key: str, text: str, keep: Sequence[str] = (), max_words: Budget = MAX_WORDS, beams: int = 1
) -> DataFrame:
    """Sentences ranked by graph rank (see ``graph_ranks``)."""
    return _scored_in_place(
        df, key, text, keep, max_words, _graph_ranks, lambda s: F.array_distinct(tokens(s)), _by_rank, beams
    )


def summarize_with(
    df: DataFrame, text: str, load: Callable[[], Callable[[list[str]], list[str]]]
) -> DataFrame:
    """Plug-in model: adds ``prediction`` and ``error``.

    ``load`` runs once per task and returns a function from a list of
    texts to their summaries. When a batch fails its texts are tried one by one,
    so that an error stays on its own row. Blank texts never reach the model.
    """

    ship_package(df.sparkSession)

    @F.pandas_udf("prediction string, error string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()
        for texts in batches:
            out = pd.DataFrame({"prediction": "", "error": None}, index=texts.index, dtype=object)
            todo = texts[texts.map(lambda t: t is not None and t.strip() != "")]
            try:
                out.loc[todo.index, "prediction"] = list(model(todo.tolist()))
            except Exception:
                for i, t in todo.items():
                    try:
                        out.at[i, "prediction"] = model([t])[0]
                    except Exception as e:
                        out.at[i, "prediction"], out.at[i, "error"] = None, str(e)
            yield out

    # Marked so that a filter on the summary cannot make Spark run the model twice.
    scored = df.withColumn("_out", run.asNondeterministic()(F.col(text)))
    return scored.withColumns(
        {"prediction": F.col("_out.prediction"), "error": F.col("_out.error")}
    ).drop("_out")


def repeated_ngrams(df: DataFrame, key: str, text: str, n: int = NO_REPEAT) -> DataFrame:
    """How many ``n``-grams a text has, how many distinct, and whether any repeats."""
    grams = ngrams(tokens(F.col(text)), n)
    return df.select(
        key,
        F.size(grams).alias("n_grams"),
        F.size(F.array_distinct(grams)).alias("n_distinct"),
    ).withColumn("repeats", F.col("n_grams") != F.col("n_distinct"))


def summarize(
    df: DataFrame,
    key: str,
    text: str,
    method: str = "lead",
    keep: Sequence[str] = (),
    max_words: Budget = MAX_WORDS,
    fit_on: DataFrame | None = None,
    beams: int = 1,
) -> DataFrame:
    """Summaries ``(key, keep, prediction)`` by one of the built-in methods.

    ``max_words`` is a number, or a column of ``df`` with one of each text's own. With
    more than one of ``beams`` the sentences are chosen by a search of that width (see
    ``beam_search``) in place of the greedy walk; ``lead`` has nothing to choose.
    """
    if isinstance(max_words, int) and not 1 <= max_words <= 512:
        raise ValueError("max_words must be between 1 and 512")
    if method == "lead":
        return summarize_lead(df, key, text, keep, max_words=max_words)
    if method == "frequency":
        return summarize_frequency(df, key, text, keep, max_words, beams)
    if method == "tfidf":
        idf = stage_table(fit_idf(df if fit_on is None else fit_on, text), "idf")
        return summarize_tfidf(df, idf, key, text, keep, max_words, beams)
    if method == "textrank":
        return summarize_textrank(df, key, text, keep, max_words, beams)
    raise ValueError(f"unknown method {method!r}")


METHODS = ("lead", "frequency", "tfidf", "textrank")
