"""textloom.sources."""
