"""PySpark-native analytics for disaster-event data."""

__version__ = "0.1.0"
