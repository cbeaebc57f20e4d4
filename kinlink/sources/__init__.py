"""Scans, sinks and fixtures."""
