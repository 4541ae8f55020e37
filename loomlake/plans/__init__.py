"""loomlake plans."""
