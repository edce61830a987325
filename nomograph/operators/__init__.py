"""The engine's operators: lazy functions from tables to DataFrames."""
