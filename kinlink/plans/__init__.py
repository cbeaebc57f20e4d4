"""Whole plans: training, prediction, and the query catalogue."""
