"""Dataset checks: splits, columns, types, emptiness, blanks and lengths.

One aggregation over the data feeds every data check. Its result has one row
per split, and the required splits and columns come from the job's contract.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from precis.functions.text import half_even, is_blank
from precis.sources.splits import PAIR_SCHEMA, union_splits

CHECK_SCHEMA = "check_key string, passed boolean, detail string"


@dataclass(frozen=True)
class Contract:
    """What a valid dataset must have."""

    splits: tuple[str, ...] = ("train", "test", "validation")
    columns: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            s: ("id", "dialogue", "summary") for s in ("train", "test", "validation")
        }
    )
    text_columns: tuple[str, ...] = ("dialogue", "summary")
    schema: T.StructType = field(default_factory=lambda: PAIR_SCHEMA)


def profile(df: DataFrame, text_columns: Sequence[str]) -> DataFrame:
    """Per split: rows and, per text column, blanks, values and characters, in one scan."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in text_columns:
        aggs += [
            F.count_if(is_blank(F.col(c))).alias(f"{c}_blank"),
            F.count(c).alias(f"{c}_values"),
            F.sum(F.length(c).cast("long")).alias(f"{c}_chars"),
        ]
    return df.groupBy("split").agg(*aggs)


def per_column(profiled: DataFrame, text_columns: Sequence[str]) -> DataFrame:
    """Profile in long form: ``(split, column, n_rows, n_blank, n_values, n_chars)``."""
    parts = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"{c}_blank").alias("n_blank"),
            F.col(f"{c}_values").alias("n_values"),
            F.coalesce(f"{c}_chars", F.lit(0)).alias("n_chars"),
        )
        for c in text_columns
    ]
    return profiled.select("split", "n_rows", F.inline(F.array(*parts)))


def _rows(spark: SparkSession, values: Sequence[tuple], schema: str) -> DataFrame:
    """A table of job parameters."""
    return spark.createDataFrame(list(values), schema)


def required_splits(spark: SparkSession, contract: Contract) -> DataFrame:
    return _rows(spark, [(s,) for s in contract.splits], "split string")


def split_exists(available: DataFrame, contract: Contract) -> DataFrame:
    """One check per required split; ``available`` has one row per split present."""
    required = required_splits(available.sparkSession, contract)
    found = available.select("split", F.lit(True).alias("found"))
    return required.join(found, "split", "left").select(
        F.concat(F.lit("split_"), "split", F.lit("_exists")).alias("check_key"),
        F.coalesce("found", F.lit(False)).alias("passed"),
        F.lit(None).cast("string").alias("detail"),
    )


def columns_present(columns: Mapping[str, Sequence[str]], spark: SparkSession, contract: Contract) -> DataFrame:
    """One check per required column of every split present. Reads schemas, not data."""
    rows = [
        (f"split_{s}_col_{c}", c in columns[s], None)
        for s, required in contract.columns.items()
        if s in columns
        for c in required
    ]
    return _rows(spark, rows, CHECK_SCHEMA)


def types_match(schemas: Mapping[str, T.StructType], spark: SparkSession, contract: Contract) -> DataFrame:
    """One check per contract column present: is its type the expected one?"""
    rows = []
    for s, schema in schemas.items():
        for want in contract.schema:
            if want.name in schema.names:
                got = schema[want.name].dataType
                detail = f"{got.simpleString()}, expected {want.dataType.simpleString()}"
                rows.append((f"split_{s}_{want.name}_type", got == want.dataType, detail))
    return _rows(spark, rows, CHECK_SCHEMA)


def _check(suffix: str, passed: Column, detail: Column) -> Column:
    key = F.concat(F.lit("split_"), "split", F.lit(suffix))
    return F.struct(key.alias("check_key"), passed.alias("passed"), detail.alias("detail"))


def _non_empty_check() -> Column:
    return _check("_non_empty", F.col("n_rows") > 0, F.concat("n_rows", F.lit(" rows")))


def _blank_checks(contract: Contract) -> list[Column]:
    return [
        _check(f"_{c}_no_nulls", F.col(f"{c}_blank") == 0, F.concat(f"{c}_blank", F.lit(" blank")))
        for c in contract.text_columns
    ]


def counted(profiled: DataFrame, present: Sequence[str]) -> DataFrame:
    """A profile with a row for each split present, empty ones with 0 rows."""
    names = _rows(profiled.sparkSession, [(s,) for s in present], "split string")
    return names.join(profiled, "split", "left").fillna(0, ["n_rows"])


def _run_checks(profiled: DataFrame, contract: Contract, checks: Sequence[Column]) -> DataFrame:
    """The checks of every required split present; those of absent columns are NULL and fall away."""
    required = F.broadcast(required_splits(profiled.sparkSession, contract))
    present = profiled.join(required, "split", "left_semi")
    return present.select(F.inline(F.array(*checks))).where(F.col("passed").isNotNull())


def non_empty(profiled: DataFrame, present: Sequence[str], contract: Contract) -> DataFrame:
    """One check per required split present; ``present`` names them, as an empty one has no profile."""
    return _run_checks(counted(profiled, present), contract, [_non_empty_check()])


def no_blanks(profiled: DataFrame, contract: Contract) -> DataFrame:
    """One check per required split present and text column."""
    return _run_checks(profiled, contract, _blank_checks(contract))


def length_stats(profiled: DataFrame, text_columns: Sequence[str]) -> DataFrame:
    """Mean characters per split and column; NULL where a split has no values."""
    mean = F.try_divide(F.col("n_chars"), F.col("n_values"))
    return per_column(profiled, text_columns).select(
        "split",
        "column",
        "n_rows",
        F.round(mean, 6).alias("mean_chars"),
        half_even(mean).cast("long").alias("mean_chars_shown"),
    )


def check_table(
    df: DataFrame,
    columns: Mapping[str, Sequence[str]],
    contract: Contract,
    profiled: DataFrame | None = None,
) -> DataFrame:
    """All checks ``(check_key, passed, detail)`` of a table with a ``split`` column.

    ``columns`` names the columns of every split that exists, empty ones included.
    """
    spark = df.sparkSession
    present = _rows(spark, [(s,) for s in columns], "split string")
    if profiled is None:
        profiled = profile(df, contract.text_columns)
    sized = counted(profiled, list(columns))
    for c in contract.text_columns:
        lacking = [s for s, names in columns.items() if c not in names]
        blanks = F.coalesce(f"{c}_blank", F.lit(0))
        sized = sized.withColumn(
            f"{c}_blank", F.when(~F.col("split").isin(lacking), blanks) if lacking else blanks
        )
    return (
        split_exists(present, contract)
        .unionByName(columns_present(columns, spark, contract))
        .unionByName(
            _run_checks(sized, contract, [_non_empty_check(), *_blank_checks(contract)])
        )
    )


def check_splits(spark: SparkSession, splits: Mapping[str, DataFrame], contract: Contract) -> DataFrame:
    """All checks of separately loaded splits, types included.

    Absent columns and splits become failed checks. A column of another type is
    counted as text, so that its split can still be checked.
    """
    columns = {s: df.columns for s, df in splits.items()}
    texts = T.StructType([T.StructField(c, T.StringType()) for c in contract.schema.names])
    empty = spark.createDataFrame([], texts)
    known = {
        s: df.select(*[F.col(c).cast("string").alias(c) for c in texts.names if c in df.columns])
        for s, df in splits.items()
    }
    table = union_splits({**known, "": empty}).where(F.col("split") != "")
    types = types_match({s: df.schema for s, df in splits.items() if s in contract.splits}, spark, contract)
    return check_table(table, columns, contract).unionByName(types)


def overall_status(checks: DataFrame) -> DataFrame:
    """Valid only when every check passed."""
    return checks.agg(
        F.bool_and("passed").alias("validation_status"),
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if(~F.col("passed")).alias("n_failed"),
    )


def report_json(checks: DataFrame) -> DataFrame:
    """The report as one JSON text: ``{"validation_status": …, "details": {key: passed}}``.

    An ``error`` or ``exception`` shows its message instead. The group is the list of checks, whose
    number the contract sets.
    """
    quoted = F.to_json(F.array("detail"))
    message = quoted.substr(F.lit(2), F.length(quoted) - 2)
    shown = F.when(F.col("check_key").isin("error", "exception"), message).otherwise(F.col("passed").cast("string"))
    entries = F.array_sort(F.collect_list(F.struct("check_key", shown.alias("shown"))))
    details = F.map_from_entries(
        F.transform(entries, lambda e: F.struct(e.check_key, F.parse_json(e.shown)))
    )
    report = F.struct(F.bool_and("passed").alias("validation_status"), details.alias("details"))
    return checks.agg(F.to_json(report, {"pretty": "true"}).alias("value"))


def write_report(checks: DataFrame, path: str) -> None:
    """Write the JSON report as one text file below ``path``."""
    report_json(checks).write.mode("overwrite").text(path)


def missing_dataset_report(spark: SparkSession, path: str) -> DataFrame:
    """The single failed check of a dataset directory that does not exist."""
    return _rows(spark, [("error", False, f"no dataset below {path}")], CHECK_SCHEMA)


def exception_report(spark: SparkSession, error: Exception) -> DataFrame:
    """The single failed check of a validation that broke off."""
    first = (str(error).splitlines() or [""])[0]
    return _rows(spark, [("exception", False, f"{type(error).__name__}: {first}")], CHECK_SCHEMA)


def require_valid(checks: DataFrame) -> None:
    """Raise unless every check passed."""
    status = overall_status(checks).first()
    if not status.validation_status:
        failed = [r.check_key for r in checks.where(~F.col("passed")).orderBy("check_key").collect()]
        raise RuntimeError(f"dataset is not valid, failed checks: {', '.join(failed)}")


def set_difference(required: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Keys only in ``required`` (missing) and only in ``actual`` (unexpected)."""
    marks = required.select(key, F.lit(1).alias("r"), F.lit(0).alias("a")).unionByName(
        actual.select(key, F.lit(0).alias("r"), F.lit(1).alias("a"))
    )
    return (
        marks.groupBy(key)
        .agg(F.max("r").alias("r"), F.max("a").alias("a"))
        .where(F.col("r") != F.col("a"))
        .select(key, F.when(F.col("r") == 1, "missing").otherwise("unexpected").alias("problem"))
    )
