"""Scalar conversions as column expressions."""
