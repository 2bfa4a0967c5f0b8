"""Workplace attendance analytics as lazy PySpark DataFrame functions."""
