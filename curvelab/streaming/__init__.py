"""Structured Streaming forms of incremental featurization (M11) and of classifying
new feature files (M9)."""

from curvelab.streaming.incremental import classify_new_files, featurize_new_files

__all__ = ["featurize_new_files", "classify_new_files"]
