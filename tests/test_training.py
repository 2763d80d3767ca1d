"""The training job: what it publishes, what a worse candidate and a dead run leave."""

import datetime as dt
import os
import random

import pytest

from zonepulse import schemas as S
from zonepulse.operators.model import linear_regression
from zonepulse.plans import training
from zonepulse.sources import versions as V


def rows(spark, noise, seed=1, n=400):
    """Demand that the first lag tells up to the noise."""
    rng = random.Random(seed)
    made = []
    for i in range(n):
        x = rng.uniform(0, 50)
        lags = [x, *[rng.uniform(0, 5) for _ in S.LAG_COLUMNS[1:]]]
        made.append((dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), 2 * x + rng.gauss(0, noise), *lags))
    return spark.createDataFrame(made, "hour_ts timestamp_ntz, target_demand double, " + ", ".join(f"{c} double" for c in S.LAG_COLUMNS))


def run(spark, root, frame):
    return training.train_and_promote(spark, root, frame, err=0, estimators={"linear_regression": linear_regression()})


def state(spark, root):
    return [tuple(r) for r in training.production_metrics(spark, root).collect()]


def test_training_job(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "models")
    assert training.production_model(spark, root) is None and state(spark, root) == []
    first = run(spark, root, rows(spark, 1.0))
    assert first.approved and first.decision.first()["first_model"] and first.version.number == 1
    before = state(spark, root)
    assert len(before) == 1 and before[0][0] == first.chosen == "linear_regression"

    # A candidate far worse than production is rejected, and leaves no file.
    held = sorted(os.listdir(f"{root}/{training.MODEL}"))
    worse = run(spark, root, rows(spark, 40.0, seed=2))
    assert not worse.approved and worse.decision.first()["decision"] == "skip_registration"
    assert state(spark, root) == before and sorted(os.listdir(f"{root}/{training.MODEL}")) == held and V.current(spark, root).number == 1

    # A job that dies between writing and publishing changes nothing that is read.
    def dies(*_):
        raise RuntimeError("killed")

    better = rows(spark, 0.1, seed=3)
    with monkeypatch.context() as m:
        m.setattr(training.V, "publish", dies)
        with pytest.raises(RuntimeError):
            run(spark, root, better)
    assert state(spark, root) == before and V.current(spark, root).number == 1

    # A better one replaces model and metrics together; the version before can still be read.
    second = run(spark, root, better)
    assert second.approved and not second.decision.first()["first_model"] and state(spark, root) != before
    assert [tuple(r) for r in training.production_metrics(spark, root, V.current(spark, root, 1)).collect()] == before
    scored = training.production_model(spark, root).transform(better).selectExpr("max(abs(prediction - target_demand)) AS worst").first()
    assert scored["worst"] < 2
    # Expiry removes the dead run's folder and the old model, not the one in production.
    V.expire(spark, root, keep=1)
    assert len(os.listdir(f"{root}/{training.MODEL}")) == 1 and training.production_model(spark, root) is not None
