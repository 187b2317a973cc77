"""Readers of raw feeds and stored tables."""
