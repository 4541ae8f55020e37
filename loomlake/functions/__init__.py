"""loomlake functions."""
