"""veritab: prove that one table equals another, and the data work around a warehouse migration, on Spark."""

__version__ = "0.1.0"
