"""Daily price-bar analytics as Spark DataFrame operators."""

from barline.plans.metrics import daily_metrics, daily_metrics_since
from barline.plans.pipeline import run_pipeline
from barline.operators.cleaning import clean_bars, stage_bars
from barline.operators.signals import trade_signals
from barline.operators.summary import symbol_summary

__all__ = [
    "clean_bars",
    "daily_metrics",
    "daily_metrics_since",
    "run_pipeline",
    "stage_bars",
    "symbol_summary",
    "trade_signals",
]
