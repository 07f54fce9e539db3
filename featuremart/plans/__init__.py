"""The jobs: each a function from input DataFrames to its result."""
