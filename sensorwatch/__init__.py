"""Sensor monitoring as DataFrame-to-DataFrame operators on Spark."""
