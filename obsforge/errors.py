"""Errors and warnings of the engine."""

from __future__ import annotations


class ObsforgeError(Exception):
    """Base of all errors that the engine raises itself."""


class UnknownQuery(ObsforgeError, KeyError):
    """No query of that name is registered."""


class MissingTable(ObsforgeError, FileNotFoundError):
    """The data folder has no table that the query reads."""


class TaskFailed(ObsforgeError):
    """A task failed in each of its attempts; the last failure is the cause."""


class RepeatedWarning(UserWarning):
    """A task failed and is tried again."""
