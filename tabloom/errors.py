"""The one error type raised for bad tables and arguments."""


class ValidationError(ValueError):
    """A table or an argument cannot be used for the requested operation."""
