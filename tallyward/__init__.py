"""Tallyward: governed business metrics as ordinary Spark jobs."""

__version__ = "0.1.0"
