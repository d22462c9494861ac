"""Logistics warehouse analytics as Spark DataFrame operators."""
