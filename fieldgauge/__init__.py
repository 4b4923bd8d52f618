"""Sensor-feature analytics and model-log monitoring as Spark DataFrame operators."""

__version__ = "0.1.0"
