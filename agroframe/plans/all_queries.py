"""All registered queries: importing this module fills the registry."""

from agroframe.plans import catalogue, embedding, evaluation, modeling, pest, sensor, smoothing, streams  # noqa: F401
from agroframe.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
