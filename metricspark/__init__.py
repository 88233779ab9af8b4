"""Label-indexed metric time series on Spark DataFrames."""

from metricspark.session import build_session

__all__ = ["build_session"]
