"""Composed jobs (M3-M8, M13): learning curves, local train/test, saved-model checks."""
