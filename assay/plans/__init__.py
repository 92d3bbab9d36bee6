"""Whole pipelines as plans over DataFrames."""
