"""All registered queries."""

from lexigrid.plans import (  # noqa: F401
    text_plans,
    query_plans,
    aggregation_plans,
    log_plans,
    ranking_plans,
    source_plans,
    stream_plans,
    result_plans,
)
from lexigrid.plans.catalog import PLANS

__all__ = ["PLANS"]
