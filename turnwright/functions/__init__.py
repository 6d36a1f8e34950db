"""Scalar functions as Column -> Column."""
