"""Viaduct: road-traffic analytics as Spark DataFrame operators."""
