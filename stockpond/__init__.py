"""stockpond: a retail lakehouse (raw -> bronze -> silver -> gold) written as Spark DataFrame jobs."""

__version__ = "0.1.0"
