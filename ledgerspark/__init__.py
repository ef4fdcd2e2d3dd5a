"""ledgerspark: Spark-native ETL, reconciliation and many-series forecasting."""

__version__ = "0.1.0"
