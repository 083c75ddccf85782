"""Whole lifecycles composed of the operators."""
