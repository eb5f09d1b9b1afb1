"""haulmark: delivery-operations analytics written as Spark DataFrame functions."""

__version__ = "0.1.0"
