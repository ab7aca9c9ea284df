"""Column expressions: no actions, no I/O."""
