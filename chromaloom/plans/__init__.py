"""Derived inputs, whole-experiment flows and the query registry."""
