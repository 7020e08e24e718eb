"""Jobs: plain functions from DataFrames to DataFrames."""
