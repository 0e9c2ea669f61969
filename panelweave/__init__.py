"""Harmonising longitudinal surveys and counting their categories, on Spark DataFrames."""
