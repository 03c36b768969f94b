"""quillon: a PySpark-native engine for financial reference and time-series data."""

__version__ = "0.1.0"
