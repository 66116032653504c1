"""textloom.functions."""
