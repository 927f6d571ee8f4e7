"""Readers (S1-S7): text, JSON, binary files and model tables into typed DataFrames."""

from curvelab.sources.readers import (
    list_inputs,
    load_mllib_model,
    parse_feature_json,
    parse_feature_lines,
    parse_label_map,
    parse_labeled_lines,
    read_feature_json,
    read_feature_lines,
    read_images,
    read_label_map,
    read_labeled_lines,
)

__all__ = [
    "read_feature_lines",
    "parse_feature_lines",
    "read_labeled_lines",
    "parse_labeled_lines",
    "read_feature_json",
    "parse_feature_json",
    "read_images",
    "list_inputs",
    "read_label_map",
    "parse_label_map",
    "load_mllib_model",
]
