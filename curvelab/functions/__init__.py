"""Column expressions (JVM-side, codegen friendly)."""

from curvelab.functions.labels import label_1v1, label_1vall
from curvelab.functions.names import base_name, class_and_num, class_from_first_digit, num_from_name
from curvelab.functions.vectors import (
    dot,
    encode_feature_json,
    encode_feature_line,
    encode_labeled_line,
    parse_vector,
    quantize,
    to_double_array,
)

__all__ = [
    "base_name",
    "class_and_num",
    "class_from_first_digit",
    "num_from_name",
    "parse_vector",
    "to_double_array",
    "quantize",
    "encode_feature_line",
    "encode_labeled_line",
    "encode_feature_json",
    "dot",
    "label_1v1",
    "label_1vall",
]
