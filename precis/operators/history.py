"""Model selection from a table of evaluation losses ``(run, step, loss)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.operators.skew import running_before, with_positions
from precis.session import stage_table


def best_step(history: DataFrame, run: str = "run", step: str = "step", loss: str = "loss") -> DataFrame:
    """The step with the lowest loss of every run; the earliest among equals."""
    best = F.min(F.struct(F.col(loss).alias("loss"), F.col(step).alias("step")))
    return (
        history.where(F.col(loss).isNotNull())
        .groupBy(run)
        .agg(F.count(F.lit(1)).alias("n_steps"), best.alias("best"))
        .select(run, "n_steps", F.col("best.step").alias("best_step"), F.col("best.loss").alias("best_loss"))
    )


def early_stop(
    history: DataFrame, run: str = "run", step: str = "step", loss: str = "loss", patience: int = 3
) -> DataFrame:
    """Where a run stops after ``patience`` evaluations without a new lowest loss.

    Returns ``run, stop_step`` (NULL when the run ends first) and the best step
    and loss up to there. Runs of any length are spread over tasks.
    """
    known = history.where(F.col(loss).isNotNull()).select(run, step, loss)
    placed = stage_table(with_positions(known, [step], [run]), "history")
    seen = running_before(placed, [run], loss, "min", "_lowest")
    better = F.col("_lowest").isNull() | (F.col(loss) < F.col("_lowest"))
    record = F.struct("pos", F.col(step).alias("step"), F.col(loss).alias("loss"))
    marked = stage_table(seen.withColumn("_record", F.when(better, record)), "history")
    last = running_before(marked, [run], "_record", "max", "_earlier")
    best = F.coalesce("_record", "_earlier")
    stopped = F.when(
        F.col("pos") - best["pos"] >= patience,
        F.struct("pos", F.col(step).alias("step"), best.alias("best")),
    )
    ends = last.groupBy(run).agg(F.min(stopped).alias("stop"), F.max("_record").alias("final"))
    chosen = F.coalesce("stop.best", "final")
    return ends.select(
        run,
        F.col("stop.step").alias("stop_step"),
        chosen["step"].alias("best_step"),
        chosen["loss"].alias("best_loss"),
    )
