"""Scalar functions, all plain column expressions."""
