"""Operators: DataFrame(s) in, DataFrame out."""
