"""scoutlab.sources."""
