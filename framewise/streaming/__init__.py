"""framewise.streaming."""
