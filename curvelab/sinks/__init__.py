"""Writers (K1-K5)."""

from curvelab.sinks.writers import (
    save_mllib_model,
    write_features,
    write_label_map,
    write_labeled_features,
    write_results,
)

__all__ = ["write_labeled_features", "write_label_map", "write_features", "save_mllib_model", "write_results"]
