"""Metric analytics on Spark: landed service snapshots in, typed metric points out."""

from gaugeloom.model import ERRORS, FIELD, METRIC, Report, Result
from gaugeloom.session import build_session, scratch_dir

__all__ = ["ERRORS", "FIELD", "METRIC", "Report", "Result", "build_session", "scratch_dir"]
