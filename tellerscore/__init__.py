"""Scoring of bank-transaction change streams, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
