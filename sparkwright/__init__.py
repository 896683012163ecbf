"""Spark-native data-processing toolkit: readers, writers, operators, jobs."""

__version__ = "0.1.0"
