"""Recommendation and preference analytics on Spark DataFrames."""
