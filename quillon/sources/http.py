"""Fetching over HTTP: transient failures are tried again, others fail at once with the provider's words."""

from __future__ import annotations

import json
import random
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable

from quillon.sources.contract import Request

# States that may pass.
TRANSIENT = {408, 425, 429, 500, 502, 503, 504}


class FetchError(RuntimeError):
    """A request that failed for good."""


def opened(url: str, timeout: float) -> tuple[int, bytes]:
    try:
        with urllib.request.urlopen(url, timeout=timeout) as r:
            return r.status, r.read()
    except urllib.error.HTTPError as e:
        return e.code, e.read()


def said(body: bytes) -> str:
    """The provider's own words: the texts in what it sent, where that is JSON, or else its beginning."""
    try:
        parts, words = [json.loads(body)], []
    except ValueError:
        return " ".join(re.sub("<[^>]*>", " ", body[:2000].decode(errors="replace")).split())[:300]
    while parts:
        x = parts.pop(0)
        if isinstance(x, dict):
            # label, value and message hold the words in the payloads of all providers
            parts = [v for k, v in x.items() if isinstance(v, dict | list) or k in ("label", "value", "message", "detail", "title", "error")] + parts
        elif isinstance(x, list):
            parts = x + parts
        elif isinstance(x, str) and x not in words:
            words.append(x)
    return "; ".join(words)[:300]


def fetch(request: Request, tries: int = 4, timeout: float = 30, wait: float = 0.5, get: Callable[[str, float], tuple[int, bytes]] = opened, sleep: Callable[[float], None] = time.sleep) -> tuple[int, bytes]:
    url = f"{request.url}?{urllib.parse.urlencode(request.params)}"
    for k in range(tries):
        try:
            status, body = get(url, timeout)
            if status < 400:
                return status, body
            why = f"HTTP {status}: {said(body)}"
            if status not in TRANSIENT:
                raise FetchError(why)
        except OSError as e:  # timeouts and broken connections
            why = str(e) or type(e).__name__
        if k < tries - 1:
            sleep(wait * 2**k * (0.5 + random.random() / 2))
    raise FetchError(f"gave up after {tries} tries: {why}")
