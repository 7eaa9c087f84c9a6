"""A deterministic stand-in for the text model: queries, bench and tests."""

from __future__ import annotations

import time

from skein.functions import jsonx as J
from skein.operators.infer import PRIMARY, RATE_LIMIT_TEXT

QUOTA_ERROR = RATE_LIMIT_TEXT
LIMITED_HOURS = 3


class StubClient:
    """The answer depends only on the prompt length ``n`` and the
    model, so a SQL oracle can recompute every call:

    * primary: ``n % 7 == 0`` raises a server error, ``n % 11 == 0`` answers
      prose (no JSON); else the first ``n % 4`` fields are filled.
    * fallback: ``n % 13 == 0`` raises a timeout; else the first
      ``(n % 3) * 3 + 1`` fields are filled.
    * ``n % 5 == 0`` appends trailing prose after the JSON object.
    """

    def __init__(self, latency_s: float = 0.0):
        self.latency_s = latency_s

    def generate(self, prompt: str, model: str, timeout: float | None = None) -> str:
        if self.latency_s:
            time.sleep(self.latency_s)
        n = len(prompt)
        if model == PRIMARY:
            if n % 7 == 0:
                raise RuntimeError("503 Service Unavailable")
            if n % 11 == 0:
                return "I cannot answer that."
            k = n % 4
        else:
            if n % 13 == 0:
                raise TimeoutError("timeout: no answer within the limit")
            k = (n % 3) * 3 + 1
        vals = [f"{f}-{n % 97}" if i < k else "" for i, f in enumerate(J.REQUIRED_FIELDS)]
        body = "{" + ",".join(f'"{f}":"{v}"' for f, v in zip(J.REQUIRED_FIELDS, vals)) + "}"
        return body + (" (end)" if n % 5 == 0 else "")


def stub_factory():
    return StubClient()


class OutageClient:
    """Never answers."""

    def generate(self, prompt: str, model: str, timeout: float | None = None) -> str:
        raise RuntimeError("503 Service Unavailable")


def outage_factory():
    return OutageClient()


class QuotaClient(StubClient):
    """Answers a prompt of length ``n`` only from hour ``n % LIMITED_HOURS`` on."""

    def __init__(self, now: float):
        super().__init__()
        self.now = now

    def generate(self, prompt: str, model: str, timeout: float | None = None) -> str:
        if self.now < 3600 * (len(prompt) % LIMITED_HOURS):
            raise RuntimeError(QUOTA_ERROR)
        return super().generate(prompt, model, timeout)


class StepClock:
    """A clock that stands still but for the waits asked of it; clients made
    by it see its time."""

    def __init__(self):
        self.t, self.waits = 0.0, []

    def now(self) -> float:
        return self.t

    def wait(self, seconds: float) -> None:
        self.waits.append(seconds)
        self.t += seconds

    def quota_client(self) -> QuotaClient:
        return QuotaClient(self.t)
