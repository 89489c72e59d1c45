"""Streaming of the register engine."""
