"""Models: pure functions from DataFrames to DataFrames, and the run that stores them."""
