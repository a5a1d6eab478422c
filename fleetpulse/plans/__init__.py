"""Warehouse models and the queries built from the operators."""
