"""Terrafold: map-feature analytics on Spark DataFrames."""
