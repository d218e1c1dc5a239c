"""framewise.sources."""
