"""caravel: a PySpark-native engine for legacy relational workloads."""

__version__ = "0.1.0"
