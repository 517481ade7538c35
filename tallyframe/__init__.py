"""Tabular analytics and regression on Spark DataFrames."""
