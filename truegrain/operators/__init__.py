"""Checks and the distributed operators under them."""
