"""DataFrame operators: ordinals, splits, labels, joins, metrics, training, scoring."""
