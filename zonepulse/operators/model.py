"""Splits, estimators, model choice and promotion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from zonepulse import schemas as S
from zonepulse.functions.columns import as_col
from zonepulse.functions.time import epoch
from zonepulse.operators.drift import regression_error
from zonepulse.operators.quantiles import exact_quantiles

METRICS = ("val_rmse", "val_mae", "val_smape", "test_rmse", "test_mae", "test_smape")


def time_cutoffs(df: DataFrame, ts: str, qs: Sequence[float] = (0.70, 0.85), err: float = 0.001) -> tuple[int, ...]:
    """Epoch seconds at the given shares of the rows; ``err`` 0 is exact."""
    seconds = df.select(epoch(ts).alias("_epoch"))
    if err == 0:
        found = exact_quantiles(seconds, ["_epoch"], qs)["_epoch"]
        return tuple(int(found[q]) for q in qs)
    return tuple(int(v) for v in seconds.approxQuantile("_epoch", list(qs), err))


def time_split(df: DataFrame, ts: str, c1: int, c2: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train up to the first cutoff, validate up to the second, test after it."""
    first, second = _time_of(df, ts, c1), _time_of(df, ts, c2)
    t = F.col(ts)
    return df.filter(t <= first), df.filter((t > first) & (t <= second)), df.filter(t > second)


def _time_of(df: DataFrame, ts: str, seconds: int):
    from datetime import datetime, timedelta

    text = (datetime(1970, 1, 1) + timedelta(seconds=seconds)).isoformat(sep=" ")
    return F.lit(text).cast(df.schema[ts].dataType)


def assembler(features: Sequence[str] = S.FEATURES, invalid: str = "skip"):
    """Vector in the one fixed order: ``skip`` drops null rows, ``keep`` serves them."""
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid=invalid)


# The settings of the three estimators.


def linear_regression():
    from pyspark.ml.regression import LinearRegression

    return LinearRegression(
        featuresCol="features", labelCol="label", predictionCol="prediction", maxIter=20, regParam=0.1, elasticNetParam=0.0
    )


def random_forest():
    from pyspark.ml.regression import RandomForestRegressor

    return RandomForestRegressor(
        featuresCol="features", labelCol="label", predictionCol="prediction", numTrees=40, maxDepth=7, seed=42
    )


def gbt():
    from pyspark.ml.regression import GBTRegressor

    return GBTRegressor(
        featuresCol="features", labelCol="label", predictionCol="prediction", maxIter=30, maxDepth=4, stepSize=0.1, seed=42
    )


CANDIDATES = {"linear_regression": linear_regression, "random_forest": random_forest, "gbt": gbt}


def fit_pipeline(train: DataFrame, estimator, features: Sequence[str] = S.FEATURES):
    """Assembler and regressor fitted as one pipeline, so that serving cannot reorder the slots."""
    from pyspark.ml import Pipeline

    labelled = train.withColumn("label", F.col("target_demand").cast("double"))
    return Pipeline(stages=[assembler(features, "skip"), estimator]).fit(labelled)


def evaluate(model, df: DataFrame, prefix: str) -> DataFrame:
    """One row of error measures."""
    preds = model.transform(df).withColumn("label", F.col("target_demand").cast("double"))
    return regression_error(preds).select(*[F.col(m).alias(f"{prefix}_{m}") for m in ("rmse", "mae", "smape")])


def compare_models(
    train: DataFrame,
    val: DataFrame,
    test: DataFrame,
    estimators: Mapping[str, object] | None = None,
    features: Sequence[str] = S.FEATURES,
) -> tuple[DataFrame, dict[str, object]]:
    """Metrics per candidate, and the fitted models.

    The three frames are kept in memory or on disk for the candidates; lost
    blocks are recomputed from their source.
    """
    from pyspark import StorageLevel

    spark = train.sparkSession
    kept = [df.persist(StorageLevel.MEMORY_AND_DISK) for df in (train, val, test)]
    rows, models = [], {}
    try:
        for name, estimator in (estimators or {n: make() for n, make in CANDIDATES.items()}).items():
            model = fit_pipeline(kept[0], estimator, features)
            v, t = evaluate(model, kept[1], "val").first(), evaluate(model, kept[2], "test").first()
            rows.append((name, *[float(x) for x in (*v, *t)]))
            models[name] = model
    finally:
        for df in kept:
            df.unpersist()
    schema = "model string, " + ", ".join(f"{m} double" for m in METRICS)
    return spark.createDataFrame(rows, schema), models


def select_model(metrics: DataFrame, gap: float = 1.0) -> DataFrame:
    """Lowest validation RMSE; the runner-up if it is within ``gap`` and has the lower SMAPE.

    The metrics table has one row per candidate.
    """
    rest = [c for c in metrics.columns if c != "val_rmse"]
    row = F.struct("val_rmse", *["model", *[c for c in rest if c != "model"]])
    two = metrics.orderBy(F.asc_nulls_last("val_rmse"), "model").limit(2)
    ranked = two.agg(F.array_sort(F.collect_list(row)).alias("_r"))
    best, second = F.get("_r", F.lit(0)), F.get("_r", F.lit(1))
    swap = (second["val_rmse"] - best["val_rmse"] < gap) & (second["val_smape"] < best["val_smape"])
    chosen = ranked.select(F.when(F.coalesce(swap, F.lit(False)), second).otherwise(best).alias("_c"))
    return chosen.select(*[F.col("_c")[c].alias(c) for c in metrics.columns])


def promotion(metrics: DataFrame, production: DataFrame | None = None) -> DataFrame:
    """Guardrails against the model in production; the first model passes if all its metrics are known.

    A candidate without a metric fails it. A metric that production lacks passes. Of several production rows the
    one with the lowest RMSE, then MAE, then SMAPE counts.
    """
    limits = S.PROMOTION_TOLERANCE
    new = metrics.select("model", *limits)
    if production is None:
        previous = {f"_old_{m}": F.lit(None).cast("double") for m in limits}
        known = F.lit(False)
    else:
        packed = production.orderBy(*[F.asc_nulls_last(m) for m in sorted(limits, key=["val_rmse", "val_mae", "val_smape"].index)]).select(F.struct(*limits).alias("_p")).limit(1).scalar()
        previous = {f"_old_{m}": packed[m] for m in limits}
        known = packed.isNotNull()
    joined = new.withColumns({**previous, "_has": known})
    checks = {f"{m}_passed": F.col(m).isNotNull() & F.coalesce(F.col(m) <= F.col(f"_old_{m}") * t, F.lit(True)) for m, t in limits.items()}
    out = joined.withColumns(checks)
    approved = F.lit(True)
    for c in checks:
        approved = approved & F.col(c)
    first = ~F.col("_has")
    return out.select(
        "model",
        *limits,
        *checks,
        approved.alias("approved"),
        first.alias("first_model"),
        F.when(approved, "register_model").otherwise("skip_registration").alias("decision"),
    )
