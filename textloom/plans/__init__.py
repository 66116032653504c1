"""textloom.plans."""
