"""Change-data and outbox event streams on Spark: parse, tag, route, fold, audit and monitor."""

__version__ = "0.1.0"
