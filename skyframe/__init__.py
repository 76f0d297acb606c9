"""Spark-native analytics for gridded Earth observations and the tables around them."""

from skyframe.session import get_session

__all__ = ["get_session"]
