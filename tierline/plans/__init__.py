"""User-level pipelines."""
