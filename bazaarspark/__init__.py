"""Commerce and marketing analytics as Spark DataFrame jobs."""

from bazaarspark.session import configure, session

__all__ = ["configure", "session"]
