"""Plinth: evidence-backed project knowledge as Spark DataFrames."""
