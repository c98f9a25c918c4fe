"""mise: clip metadata profiling, feature building, two-head training and
evaluation as Spark DataFrame plans."""

__version__ = "0.1.0"
