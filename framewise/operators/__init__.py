"""framewise.operators."""
