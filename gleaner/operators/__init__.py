"""Set-level operators: DataFrames in, DataFrame out."""
