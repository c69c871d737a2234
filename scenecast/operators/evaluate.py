"""Scoring operators.

The reference runs two evaluator jobs per model; here all models and both
metrics come out of one aggregate over a long predictions table
``(model, ..., label, prediction)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scenecast.functions.metrics import r2, rmse


def stack_predictions(df: DataFrame, prediction_cols: dict[str, str],
                      keys: list[str], label: str = "label") -> DataFrame:
    """Wide ``label, pred_a, pred_b, ...`` -> long ``model, keys, label, prediction``.

    One pass over the input (an explode of a small array per row), no union.
    """
    arr = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("prediction"))
                    for m, c in prediction_cols.items()])
    return (df.select(*keys, F.col(label).cast("double").alias("label"),
                      F.explode(arr).alias("__p"))
            .select(F.col("__p.model").alias("model"), *keys, "label",
                    F.col("__p.prediction").alias("prediction")))


def score(pred: DataFrame, group_cols: list[str] | None = None,
          label: str = "label", prediction: str = "prediction") -> DataFrame:
    """N, RMSE and R^2 per group (default: per model) in one pass.

    Rows with a null label or prediction are ignored, as the evaluator does.
    An empty group yields no row; a group with constant labels has null R^2.
    """
    group_cols = ["model"] if group_cols is None else group_cols
    ok = pred.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    return ok.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        rmse(label, prediction).alias("rmse"),
        r2(label, prediction).alias("r2"),
    )


def compare_models(scores: DataFrame) -> DataFrame:
    """Scores ranked by RMSE (ties by name); one row per model.

    The window runs over the score table, one row per model.
    """
    w = Window.orderBy(F.col("rmse").asc_nulls_last(), F.col("model"))
    return scores.withColumn("rank", F.row_number().over(w))


def scores_by_day(pred: DataFrame, ts: str = "timestamp") -> DataFrame:
    """A10 grouped by model and calendar day."""
    return score(pred.withColumn("date", F.to_date(F.col(ts))), ["model", "date"])
