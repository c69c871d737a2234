"""Model fitting and scoring on MLlib.

All four learners are MLlib estimators, so fitting is distributed: the
assembler and scaler are row-local, and the learners aggregate sufficient
statistics (normal equations / L-BFGS gradients, tree split histograms)
across executors.  The boosted model comes in two forms: second-order boosting with an L2
penalty (:mod:`scenecast.operators.boosting`) and MLlib's GBT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenecast.operators.boosting import SecondOrderBoosting
from scenecast.operators.dataset import complete
from scenecast.schemas import FEATURE_COLS
from scenecast.session import side_by_side

# Hyper-parameters of the published runs.
TREE_PARAMS = dict(maxDepth=8, minInstancesPerNode=10)
FOREST_PARAMS = dict(numTrees=100, maxDepth=8, minInstancesPerNode=20,
                     subsamplingRate=0.7, featureSubsetStrategy="sqrt")
BOOSTED_PARAMS = dict(stepSize=0.05, maxDepth=6, subsamplingRate=0.8,
                      featureSubsetStrategy="0.8", maxIter=600)
BOOSTED_L2_PARAMS = dict(rounds=600, eta=0.05, depth=6, subsample=0.8, colsample=0.8, l2=1.0)
SEED = 42

MODEL_NAMES = ["linear_regression", "decision_tree", "random_forest", "boosted_trees"]


def assembler(features: list[str] | None = None) -> VectorAssembler:
    """M1: features -> vector, rows with invalid values skipped."""
    return VectorAssembler(inputCols=list(features or FEATURE_COLS), outputCol="features",
                           handleInvalid="skip")


def linear_pipeline(features=None) -> Pipeline:
    """M2 + M3: standardise (mean and sample std) then least squares."""
    scaler = StandardScaler(inputCol="features", outputCol="scaledFeatures",
                            withMean=True, withStd=True)
    lr = LinearRegression(featuresCol="scaledFeatures", labelCol="label",
                          predictionCol="prediction")
    return Pipeline(stages=[assembler(features), scaler, lr])


def tree_pipeline(features=None, **params) -> Pipeline:
    """M4: regression tree (variance impurity, 32 bins)."""
    p = {**TREE_PARAMS, "seed": SEED, **params}
    return Pipeline(stages=[assembler(features), DecisionTreeRegressor(
        featuresCol="features", labelCol="label", predictionCol="prediction", **p)])


def forest_pipeline(features=None, **params) -> Pipeline:
    """M5: random forest."""
    p = {**FOREST_PARAMS, "seed": SEED, **params}
    return Pipeline(stages=[assembler(features), RandomForestRegressor(
        featuresCol="features", labelCol="label", predictionCol="prediction", **p)])


def boosted_l2_pipeline(features=None, **params) -> Pipeline:
    """M6: second-order boosting, L2 leaf weights, features sampled per tree."""
    p = {**BOOSTED_L2_PARAMS, "seed": SEED, **params}
    return Pipeline(stages=[assembler(features), SecondOrderBoosting(
        featuresCol="features", labelCol="label", predictionCol="prediction", **p)])


def boosted_pipeline(features=None, **params) -> Pipeline:
    """M6 on MLlib: first-order boosting, no L2 penalty, features sampled per node."""
    p = {**BOOSTED_PARAMS, "seed": SEED, **params}
    return Pipeline(stages=[assembler(features), GBTRegressor(
        featuresCol="features", labelCol="label", predictionCol="prediction", **p)])


def default_specs(features=None, boosted_rounds: int = BOOSTED_PARAMS["maxIter"],
                  forest_trees: int = FOREST_PARAMS["numTrees"], second_order: bool = True
                  ) -> dict[str, Callable[[], Pipeline]]:
    """The reference's four pipelines, by name; ``second_order=False`` takes MLlib's boosting."""
    if second_order:
        def boosted():
            return boosted_l2_pipeline(features, rounds=boosted_rounds)
    else:
        def boosted():
            return boosted_pipeline(features, maxIter=boosted_rounds)
    return {
        "linear_regression": lambda: linear_pipeline(features),
        "decision_tree": lambda: tree_pipeline(features),
        "random_forest": lambda: forest_pipeline(features, numTrees=forest_trees),
        "boosted_trees": boosted,
    }


def fit_models(train: DataFrame, specs: dict[str, Callable[[], Pipeline]],
               partitions: int | None = None, threads: int = 4) -> dict[str, PipelineModel]:
    """M7: fit every pipeline on one cached training frame, ``threads`` of them at a time.

    ``partitions`` fixes the number of partitions (sampling learners draw per
    partition); without it the frame stays as it is.
    """
    cached = (train.repartition(partitions) if partitions else train).cache()
    try:
        if len(specs) > 1:
            cached.count()            # cached once, not by every learner for itself
        return side_by_side(train.sparkSession, {
            name: lambda make=make: make().fit(cached) for name, make in specs.items()}, threads)
    finally:
        cached.unpersist()


def predict(models: dict[str, PipelineModel], frame: DataFrame,
            keys: list[str] | None = None) -> DataFrame:
    """M8 + U3: long predictions ``(model, keys..., label, prediction)``.

    All models score the frame in one pass: each adds its prediction as a
    column, and the columns are stacked per row.  A row is left out for the
    models that miss one of their own inputs, and kept for the others.  No
    model gives no rows of that layout.
    """
    keys = keys or []
    names, wide = list(models), frame
    for i, m in enumerate(models.values()):
        seen, inputs = wide.columns, []
        for stage in m.stages:
            if isinstance(stage, VectorAssembler):
                inputs += stage.getInputCols()
                stage = stage.copy({stage.handleInvalid: "keep"})
            wide = stage.transform(wide)
        made = [c for c in wide.columns if c not in seen]
        wide = wide.withColumn(f"__p{i}", F.when(
            complete(inputs), F.col("prediction").cast("double"))).drop(*made)
    stacked = F.array(*[F.struct(F.lit(n).alias("model"), F.col(f"__p{i}").alias("prediction"))
                        for i, n in enumerate(names)]).cast(
        "array<struct<model:string,prediction:double>>")
    return (wide.select(*keys, F.col("label").cast("double").alias("label"),
                        F.explode(stacked).alias("__s"))
            .filter(F.col("__s.prediction").isNotNull())
            .select(F.col("__s.model").alias("model"), *keys, "label",
                    F.col("__s.prediction").alias("prediction")))


def importances(models: dict[str, PipelineModel], features: list[str] | None = None,
                spark=None) -> DataFrame:
    """M10 + T3: (model, feature, importance, rank) for tree-based models."""
    features = list(features or FEATURE_COLS)
    rows = []
    for name, m in models.items():
        last = m.stages[-1]
        if hasattr(last, "featureImportances"):
            vals = last.featureImportances.toArray()
            order = sorted(range(len(features)), key=lambda i: (-vals[i], features[i]))
            rank = {i: r + 1 for r, i in enumerate(order)}
            rows += [(name, features[i], float(vals[i]), rank[i]) for i in range(len(features))]
    spark = spark or _spark_of(models)
    return spark.createDataFrame(
        rows, "model string, feature string, importance double, rank int")


def coefficients(model: PipelineModel, features: list[str] | None = None,
                 name: str = "linear_regression", spark=None) -> DataFrame:
    """M11 + T4: linear coefficients ranked by magnitude, sign kept.

    ``coef_scaled`` is on standardised features (what the reference plots);
    ``coef_raw`` is per original unit (coef / std; 0 where std is 0).
    """
    features = list(features or FEATURE_COLS)
    lr = model.stages[-1]
    coef = lr.coefficients.toArray()
    std = None
    for st in model.stages:
        if hasattr(st, "std") and hasattr(st, "mean"):
            std = st.std.toArray()
    order = sorted(range(len(features)), key=lambda i: (-abs(coef[i]), features[i]))
    rank = {i: r + 1 for r, i in enumerate(order)}
    rows = []
    for i, f in enumerate(features):
        raw = (float(coef[i] / std[i]) if std is not None and std[i] != 0
               else (0.0 if std is not None else float(coef[i])))
        rows.append((name, f, float(coef[i]), raw, rank[i]))
    rows.append((name, "(intercept)", float(lr.intercept), None, None))
    spark = spark or _spark_of({name: model})
    return spark.createDataFrame(
        rows, "model string, feature string, coef_scaled double, coef_raw double, rank int")


def _spark_of(models):
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()
