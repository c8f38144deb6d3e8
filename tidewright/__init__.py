"""Relational transforms, data-quality checks, audits and load modes for Spark DataFrames."""
