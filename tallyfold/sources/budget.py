"""One budget of requests for all tasks that read from a service."""

from __future__ import annotations

import socket
import socketserver
import threading
import time
from collections.abc import Callable
from typing import Protocol

#: Seconds between two requests, requests left at which to wait for the reset, seconds to wait where the reset isn't told.
PAUSE, BUFFER, UNKNOWN_RESET = 0.5, 10, 60.0


def wait_for(headers: dict[str, str], now: float, buffer: int = BUFFER) -> float:
    """Seconds to wait before the next request, by the rate limit's headers; without them, none."""
    lower = {k.lower(): v for k, v in headers.items()}
    remaining = lower.get("x-ratelimit-remaining")
    if remaining is None or float(remaining) >= buffer:
        return 0.0
    reset = lower.get("x-ratelimit-reset")
    return UNKNOWN_RESET if reset is None else max(0.0, float(reset) - now) + 1


class Bucket:
    """A turn every ``pause`` seconds at most, whoever asks, and none while held."""

    def __init__(self, pause: float = PAUSE):
        self.pause, self.free, self.lock = pause, float("-inf"), threading.Lock()

    def turn(self, now: float) -> float:
        """Takes a turn, if one is free (0), or tells in how many seconds to ask again."""
        with self.lock:
            if now < self.free:
                return self.free - now
            self.free = now + self.pause
            return 0.0

    def hold(self, until: float) -> None:
        with self.lock:
            self.free = max(self.free, until)


class Gate(Protocol):
    """What stands before each request and sees each answer's headers."""

    def enter(self) -> None: ...

    def seen(self, headers: dict[str, str]) -> None: ...


class OwnGate:
    """For one reader alone, or with ``share`` for each of so many that don't know of each other: then each has a part of the budget."""

    def __init__(self, share: int = 1, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.time):
        self.bucket, self.sleep, self.clock = Bucket(PAUSE * share), sleep, clock

    def enter(self) -> None:
        while (wait := self.bucket.turn(self.clock())) > 0:
            self.sleep(wait)

    def seen(self, headers: dict[str, str]) -> None:
        now = self.clock()
        if (wait := wait_for(headers, now)) > 0:
            self.bucket.hold(now + wait)


class _Asked(socketserver.StreamRequestHandler):
    def handle(self) -> None:
        """Lines "turn" and "hold <seconds>"; the answer is the seconds to wait."""
        for line in self.rfile:
            word, *more = line.decode().split()
            budget: Budget = self.server.budget
            if word == "hold":
                budget.bucket.hold(budget.clock() + float(more[0]))
                wait = 0.0
            else:
                wait = budget.bucket.turn(budget.clock())
            self.wfile.write(f"{wait!r}\n".encode())


class _Server(socketserver.ThreadingTCPServer):
    daemon_threads = allow_reuse_address = True


class Budget:
    """A bucket at the driver, for as long as the ``with`` lasts; ``address`` is the option ``budget`` of the paged source.

    Tasks ask it for each of their turns, so all slices of all reads together
    keep to one budget, and a wait that one answer's headers ask for holds all.
    A task that is lost after asking costs one turn.
    """

    def __init__(self, host: str = "127.0.0.1", pause: float = PAUSE, clock: Callable[[], float] = time.monotonic):
        self.bucket, self.clock = Bucket(pause), clock
        self.server = _Server((host, 0), _Asked)
        self.server.budget = self
        self.address = f"{host}:{self.server.server_address[1]}"

    def __enter__(self) -> Budget:
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        return self

    def __exit__(self, *_) -> None:
        self.server.shutdown()
        self.server.server_close()


class SharedGate:
    """Asks the driver's budget."""

    def __init__(self, address: str, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.time):
        host, _, port = address.rpartition(":")
        self.line, self.sleep, self.clock = socket.create_connection((host, int(port)), timeout=60).makefile("rw"), sleep, clock

    def _ask(self, what: str) -> float:
        self.line.write(what + "\n")
        self.line.flush()
        answer = self.line.readline()
        if not answer:
            raise ConnectionError("the budget at the driver is closed")
        return float(answer)

    def enter(self) -> None:
        while (wait := self._ask("turn")) > 0:
            self.sleep(wait)

    def seen(self, headers: dict[str, str]) -> None:
        if (wait := wait_for(headers, self.clock())) > 0:
            self._ask(f"hold {wait!r}")
