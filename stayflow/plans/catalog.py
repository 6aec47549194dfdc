"""All registered queries: importing a plan module registers its queries."""

from stayflow.plans import (  # noqa: F401
    evaluation,
    explain,
    features,
    quality,
    scoring,
    statistics,
    streams,
    training,
)
from stayflow.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
