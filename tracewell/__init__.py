"""Spark jobs over recorded signals, event logs and their statistics."""
