"""Pacing and protection of calls to the world outside, for fetchers and per-record work.

Clocks and sleeps are parameters, so that tests need no time to pass.
"""

from __future__ import annotations

import argparse
import random
import signal
import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from email.utils import parsedate_to_datetime
from typing import Any


@dataclass
class Pacer:
    """At most ``rate`` calls a second, evenly spaced."""

    rate: float
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    due: float = 0.0
    lock: Any = field(default_factory=threading.Lock)

    def wait(self) -> None:
        with self.lock:
            now = self.clock()
            start = max(now, self.due)
            self.due = start + 1.0 / self.rate
        if start > now:
            self.sleep(start - now)


@dataclass
class TokenBucket:
    """``rate`` calls a second in the long run, ``burst`` of them at once."""

    rate: float
    burst: float
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    lock: Any = field(default_factory=threading.Lock)

    def __post_init__(self) -> None:
        self.tokens, self.at = self.burst, self.clock()

    def take(self) -> None:
        while True:
            with self.lock:
                now = self.clock()
                self.tokens = min(self.burst, self.tokens + (now - self.at) * self.rate)
                self.at = now
                if self.tokens >= 1:
                    self.tokens -= 1
                    return
                need = (1 - self.tokens) / self.rate
            self.sleep(need)


@dataclass
class Cooldown:
    """A pause that grows when the other side refuses and shrinks when it answers."""

    least: float = 0.0
    start: float = 3.0
    most: float = 60.0
    grow: float = 1.8
    shrink: float = 0.85
    pause: float = 0.0

    def refused(self, asked: float | None = None) -> float:
        """The pause after a refusal; at least what the other side asked for."""
        self.pause = min(self.most, max(self.start, self.pause * self.grow, asked or 0.0))
        return self.pause

    def answered(self) -> float:
        self.pause = max(self.least, self.pause * self.shrink) if self.pause > self.start * 0.1 else self.least
        return self.pause


def retry_after(value: str | None, now: float | None = None) -> float | None:
    """Seconds that a Retry-After header asks for, in seconds or as a date; None if it says neither."""
    if not value:
        return None
    try:
        return max(0.0, float(value))
    except ValueError:
        pass
    try:
        return max(0.0, parsedate_to_datetime(value).timestamp() - (time.time() if now is None else now))
    except (TypeError, ValueError):
        return None


class Refused(Exception):
    """The other side asks to come back later."""

    def __init__(self, asked: float | None = None):
        super().__init__("refused")
        self.asked = asked


def with_retries(
    call: Callable[[], Any], tries: int = 3, delay: float = 5.0, jitter: float = 0.25,
    sleep: Callable[[float], None] = time.sleep, cooldown: Cooldown | None = None
) -> Any:
    """The call's answer; after ``Refused`` or OSError it is tried again, each time after twice the delay, give or take the jitter."""
    for k in range(tries):
        try:
            answer = call()
        except (Refused, OSError) as e:
            if k == tries - 1:
                raise
            asked = e.asked if isinstance(e, Refused) else None
            wait = delay * 2**k * (1 + random.uniform(-jitter, jitter))
            sleep(max(wait, asked or 0.0, cooldown.refused(asked) if cooldown else 0.0))
        else:
            if cooldown:
                cooldown.answered()
            return answer
    raise ValueError("tries must be at least 1")


@contextmanager
def time_limit(seconds: float) -> Iterator[None]:
    """Raise TimeoutError in the body after some seconds; only where signals work, which is the main thread of a worker."""
    if seconds <= 0 or threading.current_thread() is not threading.main_thread():
        yield
        return

    def stop(*_: object) -> None:
        raise TimeoutError(f"over {seconds:g} s")

    before = signal.signal(signal.SIGALRM, stop)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


def guarded(work: Callable[[Any], Any], seconds: float = 45.0) -> Callable[[Any], tuple[Any, str | None]]:
    """``work`` as a function to (result, error): an exception or a timeout costs one record and not the job."""

    def safe(record: Any) -> tuple[Any, str | None]:
        try:
            with time_limit(seconds):
                return work(record), None
        except TimeoutError:
            return None, "timed out"
        except Exception as e:  # noqa: BLE001
            return None, f"{type(e).__name__}: {e}"

    return safe


def screen_arguments(argv: list[str] | None = None) -> argparse.Namespace:
    """The surplus screen's command line."""
    p = argparse.ArgumentParser(description="Rank companies by current assets above all liabilities against market value")
    p.add_argument("summary")
    p.add_argument("--prices", required=True, help="CSV with symbol and close")
    p.add_argument("--rates", help="CSV with currency and per_usd")
    p.add_argument("--as-of", help="the day that staleness counts from; today by default")
    p.add_argument("--stale-days", type=int, default=730, help="0 keeps all")
    p.add_argument("--all-records", action="store_true", help="not only the latest of a ticker")
    p.add_argument("--output", required=True)
    p.add_argument("--format", choices=("txt", "tsv", "csv"), help="by default what the output's suffix says")
    return p.parse_args(argv)
