"""Composite analytics built from the operators."""
