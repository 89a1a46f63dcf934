"""Typed errors raised by the library."""


class VeritabError(Exception):
    """Base class."""


class ConfigError(VeritabError, ValueError):
    """A table configuration is not usable."""


class DataSourceError(VeritabError):
    """A table or file could not be read."""


class TableWriteError(VeritabError):
    """A result could not be stored."""


class ColumnSetError(VeritabError):
    """Two sides that must have the same columns do not."""


class ReconcileFailed(VeritabError):
    """At least one table of a run ended with an error; ``result`` holds what was computed."""

    def __init__(self, message, result=None):
        super().__init__(message)
        self.result = result


class UnsupportedThresholdType(ConfigError):
    """A threshold was asked for a column that is neither a number nor a point in time."""


class EmptyReportError(VeritabError):
    """A validation report holds no check."""
