"""scoutlab.functions."""
