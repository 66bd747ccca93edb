"""meterlake: time-partitioned meter readings, bucketed queries, rollups and
data lifecycle, built from Spark DataFrame, SQL and Structured Streaming."""

from meterlake.session import configure, get_session

__all__ = ["configure", "get_session"]
__version__ = "0.1.0"
