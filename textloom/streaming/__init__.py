"""textloom.streaming."""
