"""murmur: analysis of user feedback as Spark DataFrame jobs."""

from murmur.session import get_spark, materialize, tune

__all__ = ["get_spark", "materialize", "tune"]
