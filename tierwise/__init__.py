"""tierwise: a Spark-native medallion warehouse and sales-analytics library."""

__version__ = "0.1.0"
