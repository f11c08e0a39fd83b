"""Posts as they land."""
