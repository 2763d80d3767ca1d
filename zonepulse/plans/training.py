"""Training from feature rows to the model in production: fit, choose, hold against production, keep or publish."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from zonepulse.operators.model import METRICS, promotion
from zonepulse.plans.serving import train
from zonepulse.sources import versions as V
from zonepulse.sources.readers import load_model
from zonepulse.sources.writers import save_model

MODEL, SCORES = "production_model", "production_metrics"
#: The one key of both tables: what is in production now.
NOW = "current"
SCHEMA = "model string, " + ", ".join(f"{m} double" for m in METRICS)


@dataclass
class Trained:
    """``metrics``: a row per candidate; ``decision``: the guardrails' row of the chosen one; ``version``: what is published after the run."""

    metrics: DataFrame
    chosen: str
    decision: DataFrame
    approved: bool
    version: V.Version


def production_metrics(spark: SparkSession, root: str, version: V.Version | None = None) -> DataFrame:
    """The metrics row of the model in production; no row before the first."""
    return V.read_version(spark, root, SCORES, spark.createDataFrame([], SCHEMA).schema, version)


def production_model(spark: SparkSession, root: str, version: V.Version | None = None):
    """The fitted pipeline in production, or None before the first."""
    folder = (version or V.current(spark, root)).folders.get(MODEL, {}).get(NOW)
    return None if folder is None else load_model(f"{root.rstrip('/')}/{folder}")


def train_and_promote(spark: SparkSession, root: str, features: DataFrame, ts: str = "hour_ts", err: float = 0.001, estimators=None) -> Trained:
    """Fit all candidates on the frame, choose one, and put it into production if it passes the guardrails.

    Model and metrics are written to new folders and published by one version, so scoring never sees the one without the other, and
    a job that dies before leaves production as it was. A rejected candidate leaves no file. A candidate without a metric,
    such as from a frame too short for a validation part, is rejected.
    """
    old = V.current(spark, root)
    metrics, chosen, model = train(features, ts, err, estimators)
    row = metrics.where(metrics["model"] == chosen)
    decision = promotion(row, production_metrics(spark, root, old))
    approved = bool(decision.first()["approved"])
    version = old
    if approved:
        run = uuid.uuid4().hex
        places = {t: f"{t}/{run}/{t}" for t in (MODEL, SCORES)}
        save_model(model, f"{root.rstrip('/')}/{places[MODEL]}")
        row.coalesce(1).write.parquet(f"{root.rstrip('/')}/{places[SCORES]}")
        version = V.publish(spark, root, old, {t: {NOW: place} for t, place in places.items()})
    return Trained(metrics, chosen, decision, approved, version)
