"""Chromatin-contact analytics as PySpark DataFrame operators."""
