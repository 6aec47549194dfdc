"""DataFrame-to-DataFrame operations."""
