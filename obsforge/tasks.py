"""Named steps with attempts and a record of their times; plain functions to whoever calls them."""

from __future__ import annotations

import functools
import logging
import time
import warnings
from collections.abc import Callable

from obsforge.errors import RepeatedWarning, TaskFailed

log = logging.getLogger("obsforge.tasks")


def task(name: str | None = None, attempts: int = 1, pause_s: float = 0.0) -> Callable:
    """A decorator: the function is tried up to ``attempts`` times, and each success or failure is logged with its time.

    ``wrapped.plain`` is the function itself.
    """

    def around(f: Callable) -> Callable:
        label = name or f.__name__

        @functools.wraps(f)
        def run(*args, **kwargs):
            for k in range(1, attempts + 1):
                began = time.monotonic()
                try:
                    got = f(*args, **kwargs)
                except Exception as e:  # noqa: BLE001 - whatever it is, it counts as a failed attempt
                    log.warning("%s failed after %.3f s: %s", label, time.monotonic() - began, e)
                    if k == attempts:
                        if attempts == 1:
                            raise
                        raise TaskFailed(f"{label} failed {attempts} times") from e
                    warnings.warn(f"{label} is tried again after: {e}", RepeatedWarning, stacklevel=2)
                    time.sleep(pause_s)
                else:
                    log.info("%s took %.3f s", label, time.monotonic() - began)
                    return got

        run.plain = f
        return run

    return around
