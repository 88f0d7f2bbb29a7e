"""webloom: page index, link rank and keyword search as Spark DataFrame jobs."""

__version__ = "0.1.0"
