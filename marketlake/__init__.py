"""marketlake — a PySpark-native batch engine for market reference data,
prices and news (see README.md)."""

__version__ = "0.1.0"
