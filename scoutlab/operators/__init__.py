"""scoutlab.operators."""
