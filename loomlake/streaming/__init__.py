"""loomlake streaming."""
