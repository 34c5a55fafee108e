"""Electricity-load time series on Spark: DataFrame in, DataFrame out."""

from loadlake.session import configure, session

__all__ = ["configure", "session"]
