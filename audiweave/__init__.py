"""Audience and data-hub analytics as lazy Spark DataFrame operators."""
