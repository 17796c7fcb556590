"""Relational, window and temporal operators: DataFrame in, DataFrame out."""
