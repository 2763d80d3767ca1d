"""Batch zone scoring and model training."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from zonepulse import schemas as S
from zonepulse.operators.lags import serving_lags
from zonepulse.operators.model import compare_models, select_model, time_cutoffs, time_split
from zonepulse.operators.ranking import rank_by
from zonepulse.operators.scoring import nearby_zones, scored, scoring_grid, with_lookup, with_weather, with_zone_name


def scoring_features(
    requests: DataFrame, fact: DataFrame, zones: DataFrame, weather: DataFrame, centers: DataFrame, k: int = 4,
    history: DataFrame | None = None,
) -> DataFrame:
    """Feature rows for every requested and nearby zone of every request; ``history`` as for ``serving_lags``."""
    grid = scoring_grid(requests, zones, nearby_zones(requests, centers, k))
    rows = with_weather(grid, weather)
    lags = serving_lags(rows, fact, history=history)
    return with_lookup(rows, lags, ["pulocationid", "hour_ts"], {c: 0.0 for c in S.LAG_COLUMNS})


def score_zones(
    requests: DataFrame, fact: DataFrame, zones: DataFrame, weather: DataFrame, centers: DataFrame, model, k: int = 4,
    history: DataFrame | None = None,
) -> DataFrame:
    """Predicted demand and score per (request, zone)."""
    rows = scoring_features(requests, fact, zones, weather, centers, k, history)
    return scored(model.transform(rows)).select(
        "request_id", "hour_ts", "pulocationid", "predicted_demand", "score", "source", "prediction"
    )


def ranked_zones(scores: DataFrame, zones: DataFrame, top: int = 5) -> DataFrame:
    """Scores with their place inside the request (best first), zone name, and whether they are among the ``top``."""
    placed = rank_by(with_zone_name(scores, zones), "score", "pulocationid", ["request_id"])
    return placed.withColumn("recommended", F.col("rank") <= top)


def train(features: DataFrame, ts: str = "hour_ts", err: float = 0.001, estimators=None):
    """(metrics, chosen name, chosen model); the fitted winner is kept, not fitted again."""
    parts = time_split(features, ts, *time_cutoffs(features, ts, err=err))
    metrics, models = compare_models(*parts, estimators=estimators, features=S.feature_columns(features))
    name = select_model(metrics).first()["model"]
    return metrics, name, models[name]
