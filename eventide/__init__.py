"""eventide: JSON event mapping, landing, search and anomaly detection on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Catalyst
expressions, usable on batch DataFrames and on Structured Streaming ones.
"""

from eventide.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
