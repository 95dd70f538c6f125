"""Lifecycle data, external series and training text on Spark."""

__version__ = "0.2.0"
