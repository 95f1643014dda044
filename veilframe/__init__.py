"""veilframe: Spark-native de-identification and data-release analytics."""

__version__ = "0.1.0"
