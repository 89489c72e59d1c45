"""Functions of the register engine."""
