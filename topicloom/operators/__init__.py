"""Relational steps: DataFrame in, DataFrame out."""
