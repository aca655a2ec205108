"""Restart policies around a streaming query."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql.streaming import StreamingQuery


@dataclass(frozen=True)
class RestartPolicy:
    """fixedDelay: so many attempts; failureRate: so many failures per interval; NoRestart."""

    strategy: str = "fixedDelay"
    attempts: int = 5
    delay_seconds: float = 10
    failure_rate: int = 2
    failure_interval_seconds: float = 60

    @classmethod
    def from_setting(cls, setting: dict | None) -> "RestartPolicy":
        s = setting or {}
        return cls(
            strategy=s.get("strategy", cls.strategy),
            attempts=int(s.get("restartAttempts", cls.attempts)),
            delay_seconds=float(s.get("delayInterval", cls.delay_seconds)),
            failure_rate=int(s.get("failureRate", cls.failure_rate)),
            failure_interval_seconds=float(s.get("failureInterval", cls.failure_interval_seconds)),
        )


def run_with_restart(
    policy: RestartPolicy,
    start: Callable[[], StreamingQuery],
    *,
    clock: Callable[[], float] = time.monotonic,
    sleep: Callable[[float], None] = time.sleep,
) -> int:
    """Run a query to its end, starting it again from its checkpoint as the policy allows.

    Returns the number of restarts; raises the last error when the policy gives up.
    """
    restarts = 0
    failures: deque[float] = deque()
    kind = policy.strategy.lower()
    while True:
        try:
            start().awaitTermination()
            return restarts
        except Exception:
            now = clock()
            failures.append(now)
            while failures and now - failures[0] > policy.failure_interval_seconds:
                failures.popleft()
            if kind == "fixeddelay":
                go_on = restarts < policy.attempts
            elif kind == "failurerate":
                go_on = len(failures) <= policy.failure_rate
            else:
                go_on = False
            if not go_on:
                raise
            restarts += 1
            sleep(policy.delay_seconds)
