"""Plans of the register engine."""
