"""textloom.operators."""
