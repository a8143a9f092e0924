"""Typed errors of the library."""


class SeamfoldError(Exception):
    """Any failure that the library itself reports."""


class SourceError(SeamfoldError):
    """A source cannot be reached or is refused."""


class UnsafeArchive(SourceError):
    """An archive's entry would leave its folder, or the archive is larger than allowed."""


class BadDocument(SeamfoldError):
    """A document is missing, malformed or breaks its schema."""


class ConcurrentWrite(SeamfoldError):
    """Another writer has committed the version that was to be written."""


class CallFailed(SeamfoldError):
    """A model call failed for good; the item is marked and the run goes on."""


class BudgetExceeded(SeamfoldError):
    """A run would spend more than its budget."""


class UnknownKey(SeamfoldError, KeyError):
    """A match, persona or model that is not known."""

    def __str__(self) -> str:
        return str(self.args[0]) if self.args else ""
