"""loomlake operators."""
