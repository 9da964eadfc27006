"""Corpus auditing, retrieval evaluation and classification reporting on Spark DataFrames."""

__version__ = "0.1.0"
