"""curvelab: learning curves for linear classifiers, expressed as Spark jobs."""

__version__ = "0.1.0"
