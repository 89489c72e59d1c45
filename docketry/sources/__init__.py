"""Sources of the register engine."""
