"""All checked queries."""

from hazardspark.checks import (  # noqa: F401
    agg_checks,
    extract_checks,
    filter_checks,
    join_checks,
    ml_checks,
    source_checks,
    stream_checks,
    text_checks,
)
from hazardspark.checks.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
