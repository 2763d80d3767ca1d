"""Queries over the test tables, one or more per operator, with comparison SQL."""

from checks import io_checks, conform_checks, analysis_checks, model_checks, stored_checks  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
