"""Odds ingestion and pregame-line calibration as Spark jobs."""

__version__ = "0.1.0"
