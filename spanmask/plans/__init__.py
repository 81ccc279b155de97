"""Configuration, shared storage, size checks, and the query catalogue."""
