"""Manners of a client, around any function that fetches an address; no network here."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field


@dataclass
class Answer:
    """What a fetch gave: a status, headers in lower case and a text."""

    status: int
    text: str = ""
    headers: dict[str, str] = field(default_factory=dict)


class NotPolite(RuntimeError):
    """The answer can't be used: its status after the last try, or no page."""


def polite(fetch: Callable[[str], Answer], tries: int = 3, pause: float = 1.0, pages_only: bool = True, sleep: Callable[[float], None] = time.sleep) -> Callable[[str], str]:
    """``fetch`` with tries for answers that say to come later (429 and 5xx, a Retry-After in
    seconds is kept to) and for broken connections, a pause that doubles between them, and a
    refusal of what is no HTML page."""

    def get(address: str) -> str:
        wait, why = pause, ""
        for k in range(tries):
            if k:
                sleep(wait)
                wait *= 2
            try:
                answer = fetch(address)
            except OSError as e:
                why = f"{type(e).__name__}: {e}"
                continue
            if answer.status == 429 or answer.status >= 500:
                why = f"status {answer.status}"
                if (later := answer.headers.get("retry-after", "")).isdigit():
                    wait = max(wait, float(later))
                continue
            if answer.status >= 400:
                raise NotPolite(f"{address}: status {answer.status}")
            kind = answer.headers.get("content-type", "text/html")
            if pages_only and "html" not in kind:
                raise NotPolite(f"{address}: {kind} is no page")
            return answer.text
        raise NotPolite(f"{address}: {why}")

    return get


def is_alive(fetch: Callable[[str], Answer], address: str) -> bool:
    """Whether a feed answers at all, without raising."""
    try:
        return fetch(address).status < 400
    except OSError:
        return False
