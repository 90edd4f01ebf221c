"""Spark-native omnichannel sales analytics: ingest, conform, convert, KPIs."""

__version__ = "0.1.0"
