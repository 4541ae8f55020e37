"""loomlake sources."""
