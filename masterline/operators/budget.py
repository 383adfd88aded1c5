"""One budget of calls for all tasks of a run, granted by the driver."""

from __future__ import annotations

import secrets
import threading
import time
from collections import deque
from collections.abc import Callable
from multiprocessing.connection import Client, Connection, Listener

from pyspark.sql import SparkSession


class CallBudget:
    """At most `calls` calls of all tasks together in any `seconds` seconds.

    The driver keeps the times of the calls it granted last; a task asks for the next one, over a connection that only
    holders of this object's key get, is told how long to wait, and waits. What crosses to tasks is the driver's
    address and the key. A task that is lost has used up what it was granted, so a rerun keeps to the budget too.
    Close it, or use it as a context, when the run is over: then asking fails.
    """

    def __init__(self, spark: SparkSession, calls: int = 30, seconds: float = 60.0) -> None:
        if calls < 1:
            raise ValueError("a budget has one call or more")
        self.key = secrets.token_bytes(32)
        self._grants = _Grants(calls, seconds, self.key)
        self.address = (spark.conf.get("spark.driver.host", "127.0.0.1"), self._grants.listener.address[1])
        self._asked: Connection | None = None

    def __getstate__(self) -> dict:
        return {"key": self.key, "address": self.address, "_grants": None, "_asked": None}

    def wait(self, sleep: Callable[[float], None] = time.sleep) -> None:
        """Returns when one more call is allowed."""
        if self._asked is None:
            self._asked = Client(self.address, authkey=self.key)
        self._asked.send(None)
        sleep(self._asked.recv())

    def close(self) -> None:
        if self._grants:
            self._grants.listener.close()

    def __enter__(self) -> CallBudget:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


class _Grants:
    """The driver's side: a thread that lets tasks in, and one for each of them that answers it."""

    def __init__(self, calls: int, seconds: float, key: bytes) -> None:
        self.calls, self.seconds, self.lock = calls, seconds, threading.Lock()
        self.times: deque[float] = deque(maxlen=calls)
        self.listener = Listener(("0.0.0.0", 0), backlog=128, authkey=key)
        threading.Thread(target=self._accept, daemon=True).start()

    def _accept(self) -> None:
        while True:
            try:
                asked = self.listener.accept()
            except OSError:
                return
            except Exception:  # noqa: BLE001, S112  whoever has not the key, or went away, is let go
                continue
            threading.Thread(target=self._answer, args=(asked,), daemon=True).start()

    def _answer(self, asked: Connection) -> None:
        try:
            while True:
                asked.recv()
                asked.send(self.next_wait(time.monotonic()))
        except (EOFError, OSError):
            asked.close()

    def next_wait(self, now: float) -> float:
        """Seconds until the next call may be made; it is granted for that time."""
        with self.lock:
            at = max(now, self.times[0] + self.seconds) if len(self.times) == self.calls else now
            at = max(at, self.times[-1]) if self.times else at
            self.times.append(at)
            return at - now
