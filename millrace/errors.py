"""Errors raised while a job is being set up, before any data is read."""


class InvalidPipelineError(ValueError):
    """The declared pipeline cannot run as written."""
