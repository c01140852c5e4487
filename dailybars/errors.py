"""Exceptions raised by the engine."""


class WrongFormatError(ValueError):
    """An output format other than csv or parquet was requested."""


class WrongLedgerError(KeyError, ValueError):
    """The ledger's columns are not the expected ones (a missing date column
    is a missing key, hence also a KeyError)."""


class UnusableSourceError(ValueError):
    """A date's files hold rows, but none that a report can use."""


class RunInProgressError(RuntimeError):
    """Another run has claimed the ledger."""
