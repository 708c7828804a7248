"""tallyframe: a Spark-native engine for disclosure filings and committee money."""

__version__ = "0.1.0"
