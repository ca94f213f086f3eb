"""The one exception type of the library and how two failures of a run combine."""

from __future__ import annotations

# Server error numbers after which a rolled-back statement may be repeated
# (lock wait timeout, deadlock).
RETRYABLE_SERVER_CODES = (1205, 1213)


class SyncError(Exception):
    """A failure with a class code and the two facts a caller must know.

    ``commit_unknown``: data may or may not have become visible; look before rerunning.
    ``retryable``: the attempt is known to have changed nothing and may be repeated.
    """

    def __init__(self, code: str, message: str, *, commit_unknown: bool = False, retryable: bool = False):
        super().__init__(f"{code}: {message}")
        self.code = code
        self.message = message
        self.commit_unknown = commit_unknown
        self.retryable = retryable

    @classmethod
    def config(cls, message: str) -> "SyncError":
        return cls("INVALID_CONFIG", message)

    @classmethod
    def schema(cls, message: str) -> "SyncError":
        return cls("SCHEMA", message)

    @classmethod
    def type(cls, message: str) -> "SyncError":
        return cls("TYPE", message)

    @classmethod
    def unknown(cls, message: str) -> "SyncError":
        return cls("COMMIT_UNKNOWN", message, commit_unknown=True)

    @classmethod
    def server(cls, number: int, message: str) -> "SyncError":
        return cls("SERVER", f"{number}: {message}", retryable=number in RETRYABLE_SERVER_CODES)

    def as_dict(self) -> dict:
        return {
            "code": self.code,
            "message": self.message,
            "commit_unknown": self.commit_unknown,
            "retryable": self.retryable,
        }


def prevailing(first: SyncError | None, later: SyncError) -> SyncError:
    """Which of two failures a run reports: the first, unless the later one says more."""
    if first is None or later.commit_unknown:
        return later
    if first.code == "CANCELLED" and later.code != "CANCELLED":
        return later
    return first
