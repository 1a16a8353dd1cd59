"""barlake: market-style time-series analytics as plain PySpark DataFrame jobs."""

__version__ = "0.1.0"
