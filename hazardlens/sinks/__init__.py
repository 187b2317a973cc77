"""Writers of result and serving tables."""
