"""One registered query per operator, each over whole provided tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from precis.functions import text as T
from precis.operators import encode as E
from precis.operators import evaluate as EV
from precis.operators import fitted as FT
from precis.operators import history as H
from precis.operators import requests as R
from precis.operators import rouge as G
from precis.operators import summarize as S
from precis.operators import train as M
from precis.operators import validate as V
from precis.operators.skew import value_counts
from precis.session import scratch_path, stage_table
from precis.sources import artifacts as A
from precis.sources import splits as SP
from precis.sources.pairs import (
    SPLITS,
    dialogue_from_turns,
    load_pairs,
    read_documents,
    read_table,
)
from precis.streaming import scoring

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CONTRACT = V.Contract()
# What the validation queries ask for: beside the splits of the data an absent one, an
# empty one, one with numbers for summaries, and a column that no split has.
REQUIRED = ("train", "test", "validation", "empty", "numbers", "absent")
STRICT = V.Contract(REQUIRED, {s: ("id", "dialogue", "summary", "speaker") for s in REQUIRED})
BATCH = 8


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _joined(ids: str) -> Column:
    """An id array as text."""
    return F.array_join(F.transform(ids, lambda x: x.cast("string")), " ").alias(ids)


def _lead(spark: SparkSession, d: str) -> DataFrame:
    return S.summarize_lead(load_pairs(spark, d), "id", "dialogue", ["summary", "split"])


def _train(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.col("split") == "train")


def _vocab(pairs: DataFrame) -> DataFrame:
    return stage_table(E.build_vocab(_train(pairs), ["dialogue", "summary"]), "vocab")


def _document_requests(spark: SparkSession, d: str) -> DataFrame:
    return read_documents(spark, d)


def _turn_batches(spark: SparkSession, d: str) -> DataFrame:
    """Two consecutive conversations make one batch, with each position twice; some texts have no batch."""
    batch = F.when(F.col("conv_id") % 11 != 0, F.floor(F.col("conv_id") / 2))
    return read_table(spark, d, "conversations").select(batch.alias("batch"), F.col("turn").alias("position"), "text")


def _shared_ids(rows: DataFrame) -> DataFrame:
    """Very many rows under each of two ids, and those of the test split without one."""
    return rows.withColumn("id", F.when(F.col("split") != "test", F.substring_index("id", "-", 1)))


def _places(spark: SparkSession, d: str) -> DataFrame:
    """The pairs' ids by split, those of the test split without a split."""
    return load_pairs(spark, d).select("id", F.nullif(F.col("split"), F.lit("test")).alias("split"))


def _saved(spark: SparkSession, d: str, names: tuple[str, ...] = SPLITS) -> dict[str, DataFrame]:
    root = scratch_path(spark, "dataset")
    SP.save_splits(load_pairs(spark, d), root, names)
    return SP.load_splits(spark, root, names)


def _checked(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The dataset that the validation queries look at."""
    docs = read_table(spark, d, "documents")
    numbers = docs.select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("dialogue"), F.col("n_chars").alias("summary")
    )
    return {**_saved(spark, d, (*SPLITS, "empty")), "numbers": numbers}


def _profiled(splits: dict[str, DataFrame]) -> DataFrame:
    texts = {s: df.withColumn("summary", F.col("summary").cast("string")) for s, df in splits.items()}
    return V.profile(SP.union_splits(texts), CONTRACT.text_columns)


# Sources and sinks


@query
def load_splits(spark, d):
    return SP.union_splits(_saved(spark, d)).select("id", "split", "dialogue", "summary")


@query
def load_renamed(spark, d):
    paths = {"train": f"{d}/documents.parquet", "test": f"{d}/benchmark.parquet"}
    renames = {"doc_id": "id", "item_id": "id", "text": "dialogue"}
    loaded = SP.load_renamed(spark, paths, renames)
    return SP.union_splits({s: df.select("id", "dialogue") for s, df in loaded.items()})


@query
def dialogue_from_turns_(spark, d):
    return dialogue_from_turns(read_table(spark, d, "conversations"))


QUERIES["dialogue_from_turns"] = QUERIES.pop("dialogue_from_turns_")


@query
def save_splits(spark, d):
    names = (*SPLITS, "holdout")
    table = SP.union_splits(_saved(spark, d, names))
    present = spark.createDataFrame([(s,) for s in names], "split string")
    sizes = table.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.length("dialogue") + F.length("summary")).alias("n_chars"),
    )
    return present.join(sizes, "split", "left").fillna(0)


@query
def ingest_idempotent(spark, d):
    """The same rows in another order are kept, other rows are refused or put in their place."""
    root = scratch_path(spark, "ingest")
    pairs = load_pairs(spark, d)
    changed = pairs.where(~F.col("id").endswith("7"))
    told = {"first": SP.ingest(pairs, root, SPLITS), "again": SP.ingest(pairs.hint("rebalance", "id"), root, SPLITS)}
    try:
        told["changed"] = SP.ingest(changed, root, SPLITS)
    except ValueError:
        told["changed"] = "refused"
    sizes = {"kept": SP.union_splits(SP.load_splits(spark, root, SPLITS)).groupBy("split").count().collect()}
    told["by_choice"] = SP.ingest(changed, root, SPLITS, on_change="replace")
    now = SP.union_splits(SP.load_splits(spark, root, SPLITS)).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
    before = spark.createDataFrame([(r["split"], r["count"]) for r in sizes["kept"]], "split string, n_before long")
    return now.join(before, "split").withColumns({k: F.lit(v) for k, v in told.items()})


@query
def json_roundtrip(spark, d):
    path = scratch_path(spark, "json")
    docs = read_table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars", "text")
    A.save_json(docs, path)
    return A.load_json(spark, path, "doc_id long, lang string, source string, n_chars long, text string")


@query
def size_units(spark, d):
    n_bytes = F.octet_length("text")
    return read_table(spark, d, "documents").select(
        "doc_id", n_bytes.alias("length"), T.size_text(n_bytes).alias("size")
    )


@query
def latest_artifact(spark, d):
    bare = F.regexp_replace("url", r"(\.html)?/?([?#].*)?\z", "")
    return A.latest_artifact(
        read_table(spark, d, "pages").withColumn("bare", bare),
        "url",
        F.regexp_extract("bare", r"/([a-z]{2})/[0-9]+\z", 1),
        A.trailing_number(F.col("bare")),
    )


@query
def set_difference_check(spark, d):
    docs, labels = read_table(spark, d, "documents"), read_table(spark, d, "labels")
    return V.set_difference(docs, labels, "doc_id")


@query
def preview(spark, d):
    return SP.preview(load_pairs(spark, d))


@query
def project_columns(spark, d):
    return load_pairs(spark, d).select("id", "dialogue")


@query
def head_k(spark, d):
    return SP.head_rows(load_pairs(spark, d), 10).select("split", "id", "summary")


@query
def row_at(spark, d):
    return SP.row_at(load_pairs(spark, d), 1).select("split", "id", "dialogue")


@query
def batch_chunks(spark, d):
    return SP.batch_chunks(_places(spark, d), BATCH)


@query
def batch_progress(spark, d):
    return SP.batch_progress(SP.batch_chunks(_places(spark, d), BATCH))


# Validation


@query
def split_exists_check(spark, d):
    """Which splits the data itself has, beside the two that were put there on purpose."""
    own = load_pairs(spark, d).select("split").distinct()
    made = spark.createDataFrame([("empty",), ("numbers",)], "split string")
    return V.split_exists(own.unionByName(made), STRICT).select("check_key", "passed")


@query
def column_check(spark, d):
    columns = {s: df.columns for s, df in _checked(spark, d).items()}
    return V.columns_present(columns, spark, STRICT).select("check_key", "passed")


@query
def type_check(spark, d):
    return V.types_match({s: df.schema for s, df in _checked(spark, d).items()}, spark, STRICT)


@query
def non_empty_check(spark, d):
    splits = _checked(spark, d)
    return V.non_empty(_profiled(splits), list(splits), STRICT)


@query
def split_counts(spark, d):
    splits = _checked(spark, d)
    return V.counted(_profiled(splits), list(splits)).select("split", "n_rows")


@query
def blank_check(spark, d):
    profiled = V.profile(load_pairs(spark, d), CONTRACT.text_columns)
    return V.per_column(profiled, CONTRACT.text_columns)


@query
def length_stats(spark, d):
    return V.length_stats(
        V.profile(load_pairs(spark, d), CONTRACT.text_columns), CONTRACT.text_columns
    )


@query
def validation_report(spark, d):
    return V.check_splits(spark, _checked(spark, d), STRICT)


@query
def validation_status(spark, d):
    """Of the strict contract, and of the plain one over the data's own splits."""
    strict = V.overall_status(V.check_splits(spark, _checked(spark, d), STRICT))
    pairs = load_pairs(spark, d)
    plain = V.overall_status(V.check_table(pairs, {s: pairs.columns for s in SPLITS}, CONTRACT))
    return strict.withColumn("contract", F.lit("strict")).unionByName(plain.withColumn("contract", F.lit("plain")))


# Text functions


@query
def tokens(spark, d):
    toks = T.tokens(F.col("text"))
    return read_documents(spark, d).select("doc_id", toks.alias("t")).select(
        "doc_id", F.size("t").alias("n_tokens"), F.array_join("t", " ").alias("tokens")
    )


@query
def sentences(spark, d):
    return read_documents(spark, d).select(
        "doc_id", F.posexplode(T.sentences(F.col("text"))).alias("sent", "sentence")
    )


@query
def ngrams(spark, d):
    grams = T.ngrams(T.tokens(F.col("text")), 2)
    return value_counts(read_documents(spark, d).select(F.explode(grams).alias("gram")), "gram", "n")


@query
def clean_summary(spark, d):
    return read_documents(spark, d).select(
        "doc_id", T.tidy(T.strip(F.col("text"))).alias("cleaned")
    )


@query
def repeated_ngrams(spark, d):
    return S.repeated_ngrams(load_pairs(spark, d), "id", "dialogue")


# Encoding


@query
def vocab(spark, d):
    return E.build_vocab(_train(load_pairs(spark, d)), ["dialogue", "summary"])


@query
def encode_inputs(spark, d):
    pairs = load_pairs(spark, d)
    coded = E.encode(pairs, "id", {"dialogue": E.MAX_INPUT}, _vocab(pairs))
    return coded.select("id", _joined("dialogue_ids"), _joined("dialogue_mask"))


@query
def encode_labels(spark, d):
    pairs = load_pairs(spark, d)
    coded = E.encode(pairs, "id", {"summary": E.MAX_TARGET}, _vocab(pairs))
    return coded.select("id", _joined("summary_ids"))


@query
def dynamic_pad(spark, d):
    pairs = load_pairs(spark, d)
    coded = E.encode(pairs, "id", {"dialogue": E.MAX_INPUT}, _vocab(pairs), pad=False)
    chunks = SP.batch_chunks(pairs.select("id", "split"), BATCH)
    batched = E.pad_to_longest(chunks.join(coded, "id"), "dialogue_ids")
    return batched.select("id", "split", "chunk", F.size("dialogue_ids").alias("n_ids"), _joined("dialogue_ids"))


@query
def decode_ids(spark, d):
    pairs = load_pairs(spark, d)
    known = _vocab(pairs)
    coded = E.encode(pairs, "id", {"summary": E.MAX_TARGET}, known)
    return E.decode(coded, "id", ["summary_ids"], known)


@query
def label_unmask(spark, d):
    pairs = load_pairs(spark, d)
    coded = E.encode(pairs, "id", {"summary": E.MAX_TARGET}, _vocab(pairs))
    masked = coded.withColumn("masked", E.mask_padding(F.col("summary_ids")))
    return masked.withColumn("labels", E.unmask_labels(F.col("masked"))).select(
        "id",
        F.size(F.filter("masked", lambda x: x == E.IGNORE)).alias("n_ignored"),
        _joined("labels"),
    )


@query
def compute_metrics(spark, d):
    lead = _lead(spark, d)
    known = _vocab(load_pairs(spark, d))
    coded = E.encode(lead, "id", {"prediction": E.MAX_TARGET, "summary": E.MAX_TARGET}, known)
    ids = coded.select(
        "id", F.col("prediction_ids"), E.mask_padding(F.col("summary_ids")).alias("label_ids")
    )
    return E.compute_metrics(ids, "id", "prediction_ids", "label_ids", known)


# Summaries


@query
def summarize_lead(spark, d):
    return _lead(spark, d).select("id", "split", "prediction")


@query
def summarize_frequency(spark, d):
    return S.summarize(load_pairs(spark, d), "id", "dialogue", "frequency", ["split"])


@query
def summarize_beam(spark, d):
    return S.summarize(load_pairs(spark, d), "id", "dialogue", "frequency", ["split"], beams=S.BEAMS)


@query
def summarize_tfidf(spark, d):
    pairs = load_pairs(spark, d)
    return S.summarize(_shared_ids(pairs), "id", "dialogue", "tfidf", ["split"], fit_on=_train(pairs))


@query
def summarize_textrank(spark, d):
    return S.summarize(load_pairs(spark, d), "id", "dialogue", "textrank", ["split"])


@query
def train_sentence_model(spark, d):
    features = M.sentence_features(load_pairs(spark, d), "id", "dialogue", "summary", ["split"])
    return M.train_sentence_model(features)[1]


@query
def oracle_labels(spark, d):
    return M.oracle_labels(load_pairs(spark, d), "id", "dialogue", "summary", ["split"])


@query
def saved_tfidf_model(spark, d):
    """Word weights learned from the train split, saved, loaded, and asked in two batches of requests."""
    pairs = load_pairs(spark, d)
    path = scratch_path(spark, "tfidf-model")
    PipelineModel([FT.TfidfSummariser(textCol="dialogue").fit(_train(pairs))]).save(path)
    fitted = PipelineModel.load(path)
    odd = F.crc32(F.col("id").cast("binary")) % 2 == 1
    parts = [R.predict(pairs.where(odd == F.lit(x)), "id", "dialogue", ["split"], fitted=fitted) for x in (True, False)]
    return parts[0].unionByName(parts[1]).select("id", "split", "summary", "summary_length", "error")


@query
def sentence_features(spark, d):
    features = M.sentence_features(load_pairs(spark, d), "id", "dialogue", "summary", ["split"])
    return features.select("id", "split", "sent", "n_words", "frequency", "overlap", "label")


@query
def training_sizes(spark, d):
    """What the sentence model learns from, by split."""
    features = M.sentence_features(load_pairs(spark, d), "id", "dialogue", "summary", ["split"])
    return features.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_sentences"), F.sum("label").cast("long").alias("n_chosen")
    )


# Scores


def _rouge(spark: SparkSession, d: str, metric: str, stemmed: bool = False) -> DataFrame:
    return G.rouge_scores(
        _shared_ids(_lead(spark, d)), ["id"], "prediction", "summary", [metric], ["split"], stemmed
    )


@query
def rouge1(spark, d):
    return _rouge(spark, d, "rouge1")


@query
def rouge2(spark, d):
    return _rouge(spark, d, "rouge2")


@query
def rougeL(spark, d):
    return _rouge(spark, d, "rougeL")


@query
def rougeLsum(spark, d):
    return _rouge(spark, d, "rougeLsum")


@query
def rouge1_stemmed(spark, d):
    return _rouge(spark, d, "rouge1", stemmed=True)


def _compared(spark: SparkSession, d: str) -> DataFrame:
    """Corpus ROUGE of all methods, from pairs that are built once."""
    pairs = stage_table(load_pairs(spark, d), "pairs")
    return EV.evaluate(pairs, S.METHODS, fit_on=_train(pairs))


@query
def pair_predictions(spark, d):
    pairs = load_pairs(spark, d)
    lead = S.summarize_lead(pairs, "id", "dialogue", ["split"])
    return EV.pair_predictions(lead, pairs.select("id", "split", "summary"), ["split", "id"])


@query
def rouge_corpus(spark, d):
    return _compared(spark, d)


@query
def metric_batches(spark, d):
    """Scores that come in three batches, one of them twice, as one table of states."""
    lead = _lead(spark, d).withColumn("day", F.crc32(F.col("id").cast("binary")) % 3)
    table = G.MetricTable(scratch_path(spark, "metric-states"), ["split", "metric"])
    for day in (0, 1, 2, 1):
        table.add_batch(G.rouge_scores(lead.where(F.col("day") == day), ["id"], "prediction", "summary", keep=["split"]), f"day{day}")
    return table.compute(spark)


@query
def rouge_bootstrap(spark, d):
    scores = G.rouge_scores(
        _lead(spark, d), ["id"], "prediction", "summary", G.METRICS, ["split"]
    )
    return G.bootstrap_interval(scores, "id", ["split"], G.METRICS)


@query
def metrics_rounded(spark, d):
    shown = _compared(spark, d).select("model", "split", "metric", F.round("f1", 4).alias("f1"))
    return shown.coalesce(1).sortWithinPartitions("model", "split", "metric")


@query
def metrics_wide(spark, d):
    path = scratch_path(spark, "metrics")
    A.write_metrics(A.metrics_wide(_compared(spark, d), ["model", "split"]), path)
    schema = ", ".join(["model string", "split string", *(f"{m} double" for m in G.METRICS)])
    written = {
        "csv": spark.read.schema(schema).option("header", True).csv(f"{path}.csv"),
        "json": spark.read.schema(schema).json(f"{path}.json"),
    }
    csv, json = (df.withColumn("file", F.lit(kind)) for kind, df in written.items())
    return csv.unionByName(json)


@query
def evaluate_models(spark, d):
    return A.metrics_wide(_compared(spark, d), ["model", "split"])


# Requests


def _budget(number: str) -> Column:
    """A request's own number of words: 0 (too low) to 30, null for every seventh request."""
    return F.when(F.col(number) % 7 != 0, F.col(number) % 31).cast("int")


@query
def request_validation(spark, d):
    checked = R.validate_requests(_document_requests(spark, d))
    return checked.select("doc_id", F.length("text").alias("n_chars"), "status")


@query
def request_validation_trimmed(spark, d):
    checked = R.validate_requests(_document_requests(spark, d), trim=True)
    return checked.select("doc_id", F.length(T.strip(F.col("text"))).alias("n_chars"), "status")


@query
def batch_validation(spark, d):
    return R.validate_batches(_turn_batches(spark, d), "batch").select("batch", "position", "status")


@query
def predict_batch(spark, d):
    asked = _turn_batches(spark, d).withColumn("max_length", _budget("position"))
    batches = R.predict_batches(asked, "batch", "position", max_length="max_length")
    return batches.select("batch", "count", F.inline("results")).drop("timestamp")


@query
def compression(spark, d):
    responses = R.predict(load_pairs(spark, d), "id", "dialogue", ["split"])
    return responses.select(
        "id",
        "split",
        "input_length",
        "summary_length",
        R.compression(F.col("input_length"), F.col("summary_length")).alias("compression"),
    )


@query
def scoring_log(spark, d):
    checked = R.validate_requests(_document_requests(spark, d))
    answered = R.predict(checked, "doc_id", "text", ["status"])
    ok = F.col("status") == "ok"
    log = answered.select(
        "status", "input_length", F.when(ok, F.col("summary_length")).alias("summary_length"), "timestamp"
    )
    return R.scoring_log(stage_table(log, "scoring_log"))


# Streams


@query
def stream_predict(spark, d):
    out, checkpoint = scratch_path(spark, "responses"), scratch_path(spark, "checkpoint")
    arrivals = scoring.stream_named(spark, d, "documents", "doc_id long, text string")
    asked = arrivals.withColumn("max_length", _budget("doc_id"))
    scoring.score_stream(asked, out, checkpoint, "doc_id", max_length="max_length").awaitTermination()
    return spark.read.parquet(out).select("doc_id", "status", "summary", "summary_length", "error")


@query
def stream_predict_once(spark, d):
    """Requests in four deliveries, each also with a third of the one before: every one is answered once."""
    docs = read_documents(spark, d).select(
        "doc_id", "text", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("doc_id") % 600).alias("sent")
    )
    folder = scratch_path(spark, "deliveries")
    out, checkpoint = scratch_path(spark, "responses"), scratch_path(spark, "checkpoint")

    def answer() -> None:
        """Go on from the checkpoint with all files of what has come since."""
        arrivals = scoring.stream_table(spark, folder, "doc_id long, text string, sent timestamp", "*.parquet")
        scoring.score_stream(arrivals, out, checkpoint, "doc_id", sent="sent", within="1 hour").awaitTermination()

    part = F.col("doc_id") % 4
    for n in range(4):
        again = (part == (n - 1) % 4) & (F.col("doc_id") % 3 == 0)
        docs.where((part == n) | again).write.parquet(f"{folder}/delivery={n}")
        answer()
    answer()  # nothing new
    return spark.read.parquet(out).select("doc_id", "status", "summary", "summary_length", "error")


@query
def stream_window_totals(spark, d):
    """Events per day and kind, kept up to date by a stateful aggregation as they come in pieces."""
    folder = scratch_path(spark, "event-pieces")
    read_table(spark, d, "events").select("ts", "event_type", "value").repartition(4, "ts").write.parquet(folder)
    arrivals = scoring.stream_table(spark, folder, "ts timestamp, event_type string, value double", "*.parquet", 1)
    cents = {"cents": F.sum(F.round(F.col("value") * 100).cast("long")), "highest": F.max("value")}
    # The pieces hold events of all days, so the delay covers them all and none is late.
    totals = scoring.window_totals(arrivals, "ts", "1 day", "3650 days", ["event_type"], cents)
    out, checkpoint = scratch_path(spark, "totals"), scratch_path(spark, "checkpoint")
    scoring.totals_stream(totals, out, checkpoint).awaitTermination()
    shown = F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start")
    return scoring.latest_totals(spark.read.parquet(out), ["event_type"]).select(shown, "event_type", "n_rows", "cents", "highest")


@query
def stream_blank_check(spark, d):
    out, checkpoint = scratch_path(spark, "checks"), scratch_path(spark, "checkpoint")
    arrivals = scoring.stream_named(spark, d, "conversations", "role string, text string")
    scoring.check_stream(arrivals, "role", ["text"], out, checkpoint).awaitTermination()
    return scoring.check_totals(spark.read.parquet(out)).withColumnRenamed("split", "role")


# Loss histories


def _losses(spark: SparkSession, d: str) -> DataFrame:
    """Events as evaluations: a user is a run, an event a step, its value the loss; every tenth run has no name."""
    return read_table(spark, d, "events").select(
        F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("run"), F.col("event_id").alias("step"), F.col("value").alias("loss")
    )


@query
def best_step(spark, d):
    return H.best_step(_losses(spark, d))


@query
def early_stop(spark, d):
    return H.early_stop(_losses(spark, d))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Check the pairs, summarise every dialogue, and score all splits."""
    return EV.evaluate(load_pairs(spark, d), ["lead", "frequency"])
