"""citeforge: a Spark-native bibliographic analytics engine."""

__version__ = "0.1.0"
