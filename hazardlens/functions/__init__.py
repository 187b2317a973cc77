"""Native column expressions (no Python workers)."""
