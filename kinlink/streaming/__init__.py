"""Linkage of arriving records."""
