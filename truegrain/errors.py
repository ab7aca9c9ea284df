"""Errors a caller can act on."""


class RuleError(ValueError):
    """A check was given a column, parameter or test name it cannot work with."""
