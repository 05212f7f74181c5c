"""Wearable and health export analytics on Spark: ingest, daily metrics, queries."""

from vitalgrid.params import DEFAULT_PARAMS, MetricParams
from vitalgrid.plans.ingest import ingest
from vitalgrid.plans.metrics import build_daily_metrics

__all__ = ["DEFAULT_PARAMS", "MetricParams", "build_daily_metrics", "ingest"]
