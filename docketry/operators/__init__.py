"""Operators of the register engine."""
