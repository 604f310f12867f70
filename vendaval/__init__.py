"""vendaval: DataFrame operators and plans for a commerce lakehouse on Apache Spark."""

__version__ = "0.1.0"
