"""Operators: DataFrame-to-DataFrame building blocks."""
