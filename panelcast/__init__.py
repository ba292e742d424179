"""panelcast: panel time-series analytics on Spark.

Lazily composed DataFrame transforms for quarterly panels: ingestion and
calendar alignment, leak-free window features, time-based splits, Spark ML
regressors with intervals, evaluation reports and batch/stream scoring.
"""

from panelcast.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
