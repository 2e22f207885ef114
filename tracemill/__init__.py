"""Spark-native log-trace analytics: flat log rows in, gated trace documents out."""

from tracemill.config import EngineConfig
from tracemill.plans.batch import BatchOutcome, prepare_documents, run_batch

__all__ = ["BatchOutcome", "EngineConfig", "prepare_documents", "run_batch"]
