"""The models: plain functions from DataFrames to a DataFrame."""
