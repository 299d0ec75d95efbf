"""Summarisers as ``pyspark.ml`` stages, so that one saved model turns raw texts into summaries."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.operators.summarize import MAX_WORDS, choose_sentences, fit_idf, summarize_tfidf
from precis.operators.train import FEATURES, sentence_rows
from precis.session import stage_table

# Columns that carry a text's place and its other columns from the first stage to the last.
ROW, DOC = "_row", "_doc"


class _TextParams(Params):
    textCol = Param(Params._dummy(), "textCol", "column with the text", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "column for the summary", TypeConverters.toString)
    maxWords = Param(Params._dummy(), "maxWords", "most words of a summary", TypeConverters.toInt)

    def _start(self, given: dict) -> None:
        self._setDefault(textCol="text", outputCol="prediction", maxWords=MAX_WORDS)
        self._set(**{k: v for k, v in given.items() if v is not None})


class SentenceRows(Transformer, _TextParams, DefaultParamsReadable, DefaultParamsWritable):
    """One row per sentence with its features, and one for a text without any.

    Texts are numbered in a staged table, so their keys may repeat or be null; their own
    columns ride on the first of their rows.
    """

    @keyword_only
    def __init__(self, *, textCol=None):
        super().__init__()
        self._start(self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        numbered = stage_table(
            dataset.select(F.struct(*dataset.columns).alias(DOC), F.monotonically_increasing_id().alias(ROW)), "texts"
        )
        text = f"{DOC}.{self.getOrDefault(self.textCol)}"
        rows = sentence_rows(numbered.withColumn("_content", F.col(text)), "_content")
        flat = rows.select(ROW, DOC, F.inline_outer("_sents"))
        first = F.coalesce(F.col("sent"), F.lit(0)) == 0
        features = [F.coalesce(c, F.lit(0.0)).alias(c) for c in FEATURES]
        return flat.select(ROW, F.when(first, F.col(DOC)).alias(DOC), "sent", "sentence", *features)


class SentenceChoice(Transformer, _TextParams, DefaultParamsReadable, DefaultParamsWritable):
    """From sentences with a ``probability`` to one summary per text, beside the text's own columns."""

    @keyword_only
    def __init__(self, *, outputCol=None, maxWords=None):
        super().__init__()
        self._start(self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        order = -F.floor(vector_to_array("probability")[1] * 1_000_000)
        ranked = F.collect_list(
            F.when(F.col("sent").isNotNull(), F.struct(order.alias("order"), "sent", "sentence"))
        )
        summary = choose_sentences(F.col("_ranked"), self.getOrDefault(self.maxWords))
        return (
            dataset.groupBy(ROW)
            .agg(F.array_sort(ranked).alias("_ranked"), F.first(DOC, ignorenulls=True).alias(DOC))
            .select(f"{DOC}.*", summary.alias(self.getOrDefault(self.outputCol)))
        )


def trained_summariser(scorer: PipelineModel, text: str, max_words: int = MAX_WORDS, out: str = "prediction") -> PipelineModel:
    """A model on raw texts around a scorer of sentence features: it keeps all columns and adds the summary."""
    first, last = SentenceRows(textCol=text), SentenceChoice(outputCol=out, maxWords=max_words)
    return PipelineModel([first, *scorer.stages, last])


class TfidfSummariser(Estimator, _TextParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the word weights of TF-IDF summaries from the texts it is fitted on."""

    @keyword_only
    def __init__(self, *, textCol=None, outputCol=None, maxWords=None):
        super().__init__()
        self._start(self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TfidfModel:
        model = TfidfModel()
        model.idf = stage_table(fit_idf(dataset, self.getOrDefault(self.textCol)), "idf")
        return self._copyValues(model)


class TfidfModel(Model, _TextParams, MLReadable, MLWritable):
    """Adds the TF-IDF summary with the weights learned once, to whatever rows and batches come."""

    idf: DataFrame

    def __init__(self):
        super().__init__()
        self._start({})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        first, *others = dataset.columns
        text, out = self.getOrDefault(self.textCol), self.getOrDefault(self.outputCol)
        summed = summarize_tfidf(dataset, self.idf, first, text, others, self.getOrDefault(self.maxWords))
        return summed.withColumnRenamed("prediction", out)

    def write(self) -> MLWriter:
        return _TfidfWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TfidfReader()


class _TfidfWriter(MLWriter):
    def __init__(self, model: TfidfModel):
        super().__init__()
        self._model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self._model, path, self.sparkSession)
        self._model.idf.write.parquet(f"{path}/idf")


class _TfidfReader(MLReader):
    def load(self, path: str) -> TfidfModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = TfidfModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.idf = self.sparkSession.read.parquet(f"{path}/idf")
        return model
