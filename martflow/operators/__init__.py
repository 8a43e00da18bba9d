"""DataFrame operators. Each takes and returns lazy DataFrames."""
