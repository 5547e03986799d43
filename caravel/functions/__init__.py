"""The dialect's scalar functions as Spark SQL."""

from .mapping import FUNCTIONS, spark_name

__all__ = ["FUNCTIONS", "spark_name"]
