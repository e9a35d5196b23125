"""Errors raised at the edges of a batch; transformations themselves never raise."""


class BatchError(RuntimeError):
    """A batch cannot go on: unreadable, empty or contract-breaking input."""


class DataNotFound(LookupError):
    """A serving query has no rows for the requested date."""
