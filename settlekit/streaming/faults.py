"""Errors of a drain by class, and bounded retries around it.

* ``retriable``: the store, the network or an executor failed; the same step may pass.
* ``soft``: a part of the log cannot be had any more; the drain goes on without it
  (``SoftFault``) and reports what it left out.
* ``fatal``: the data or the program is at fault (malformed bodies, drift, the
  identifier guard, lost offsets); trying again gives the same.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from settlekit.sources.commits import CommitConflict

log = logging.getLogger(__name__)

RETRIABLE, SOFT, FATAL = "retriable", "soft", "fatal"


class SoftFault(RuntimeError):
    """A source went on without something; ``left_out`` says what."""

    def __init__(self, message: str, left_out: Any = None):
        super().__init__(message)
        self.left_out = left_out


# By simple class name of a Java exception anywhere in the chain of causes.
RETRIABLE_CAUSES = (
    "SocketException", "SocketTimeoutException", "ConnectException", "NoRouteToHostException", "UnknownHostException", "TimeoutException",
    "InterruptedIOException", "ClosedChannelException", "EOFException", "RetriableException", "RetryableException", "DisconnectException",
    "NotLeaderOrFollowerException", "CoordinatorNotAvailableException", "FetchFailedException", "ExecutorLostFailure", "BlockMissingException",
    "SafeModeException", "StandbyException")
# Error conditions and classes whose repetition is of no use, whatever they are wrapped around.
FATAL_CAUSES = ("MALFORMED_RECORD", "SchemaDriftError", "IdentifierGuardError", "AnalysisException", "ParseException")


def _names(error: BaseException) -> list[str]:
    """Class names and error conditions of an error and its causes, Python's and Java's."""
    found, seen, e = [], set(), error
    while e is not None and id(e) not in seen:
        seen.add(id(e))
        found += [c.__name__ for c in type(e).__mro__]
        condition = getattr(e, "getCondition", None)
        if callable(condition):
            try:
                found.append(str(condition()))
            except Exception:  # noqa: BLE001 - an error without a condition
                pass
        java = getattr(e, "java_exception", None) or getattr(e, "_origin", None)
        while java is not None:
            try:
                found.append(java.getClass().getSimpleName())
                found.append(str(java.getMessage())[:500])
                java = java.getCause()
            except Exception:  # noqa: BLE001 - not a Java object
                java = None
        found.append(str(e)[:4000])
        e = e.__cause__ or e.__context__
    return found


def classify(error: BaseException) -> str:
    """The class of an error, from the types, conditions and messages along its causes."""
    if isinstance(error, SoftFault):
        return SOFT
    names = _names(error)
    if any(mark in text for mark in FATAL_CAUSES for text in names):
        return FATAL
    if isinstance(error, (ConnectionError, TimeoutError, InterruptedError, CommitConflict)):
        return RETRIABLE
    return RETRIABLE if any(mark in text for mark in RETRIABLE_CAUSES for text in names) else FATAL


@dataclass
class Outcome:
    """How a step ended: ``ok``, or ``partial`` if it went on without something; its result, attempts and the errors met."""

    status: str
    result: Any
    attempts: int
    errors: list[tuple[str, str]] = field(default_factory=list)


def with_retries(step: Callable[[], Any], attempts: int = 4, wait_seconds: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> Outcome:
    """Run ``step`` until it passes, at most ``attempts`` times, waiting twice as long each time.

    A fatal error is raised at once, a retriable one after the last attempt; a soft one ends the step as ``partial``.
    """
    errors: list[tuple[str, str]] = []
    for attempt in range(1, attempts + 1):
        try:
            return Outcome("ok", step(), attempt, errors)
        except Exception as e:  # noqa: BLE001 - classified below
            kind = classify(e)
            errors.append((kind, f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"[:300]))
            if kind == SOFT:
                log.warning("went on without a part: %s", e)
                return Outcome("partial", getattr(e, "left_out", None), attempt, errors)
            if kind == FATAL or attempt == attempts:
                raise
            log.warning("attempt %d of %d failed, trying again: %s", attempt, attempts, errors[-1][1])
            sleep(wait_seconds * 2 ** (attempt - 1))
    raise AssertionError("attempts must be at least 1")
