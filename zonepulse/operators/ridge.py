"""Ridge regression by its normal equations: one aggregation of the rows, then a system as small as the number of features.

The fit is that of the linear candidate (features and label scaled by their deviations, the penalty on scaled weights, the
intercept free), without a pass per iteration; sums of any parts of the rows could be added up.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from zonepulse.functions.columns import as_col

INTERCEPT = "intercept"


def gram(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One row: n, means (features, then label) and the upper half of their covariances; rows with a null among them are left out."""
    names = [*features, label]
    rows = df.select(*[as_col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)]).dropna()
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    return rows.agg(
        F.count("*").alias("n"),
        F.array(*[F.avg(f"x{i}") for i in range(len(names))]).alias("means"),
        F.array(*[F.covar_pop(f"x{i}", f"x{j}") for i, j in pairs]).alias("covariances"),
    )


def ridge(df: DataFrame, features: Sequence[str], label: str, penalty: float = 0.1) -> dict[str, float]:
    """Weight of each feature, and the intercept; a feature that does not vary weighs nothing."""
    row = gram(df, features, label).first()
    d = len(features)
    if not row["n"]:
        raise ValueError("no complete rows to fit")
    cov = np.zeros((d + 1, d + 1))
    cov[np.triu_indices(d + 1)] = row["covariances"]
    cov = np.triu(cov) + np.triu(cov, 1).T
    deviation = np.sqrt(np.diag(cov))
    moving = np.flatnonzero(deviation[:d] > 0)
    weights = np.zeros(d)
    if deviation[d] > 0 and len(moving):
        a = cov[np.ix_(moving, moving)] + np.diag(deviation[moving] ** 2 * (penalty / deviation[d]))
        weights[moving] = np.linalg.solve(a, cov[moving, d])
    return {**dict(zip(features, weights.tolist(), strict=True)), INTERCEPT: float(row["means"][d] - weights @ np.array(row["means"][:d]))}


def linear(weights: Mapping[str, float]) -> Column:
    """The prediction of a row."""
    total = F.lit(weights[INTERCEPT])
    for name, w in weights.items():
        if name != INTERCEPT:
            total = total + as_col(name) * w
    return total
