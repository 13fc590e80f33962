"""marketloom: Spark-native analytics over financial news and market data."""

__version__ = "0.1.0"
