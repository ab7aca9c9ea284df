"""The same checks on tables that keep arriving."""
