"""Dataflow operators, each a function from DataFrames to a DataFrame.

Joins carry no broadcast hints unless the broadcast side is bounded by a parameter: whether a
lookup is small enough is left to Spark's own size check, and beyond it adaptive execution
splits skewed join keys.
"""
