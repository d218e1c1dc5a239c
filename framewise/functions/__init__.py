"""framewise.functions."""
