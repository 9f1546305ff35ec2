"""Operators: DataFrame in, DataFrame out, built from Spark expressions."""
