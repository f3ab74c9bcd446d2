"""Spark-native analytics over logged decision trajectories."""

__version__ = "0.1.0"
