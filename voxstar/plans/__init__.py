"""Analytics plans built from operators and functions."""
