"""Ready-made analytics for tables and event streams, built on Spark DataFrames."""

__version__ = "0.1.0"
