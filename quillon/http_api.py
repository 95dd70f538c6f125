"""The questions of the service over HTTP, as JSON, with the standard library's server."""

from __future__ import annotations

import json
import logging
import re
import time
import uuid
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from inspect import signature
from urllib.parse import parse_qsl, unquote, urlsplit

from quillon.serving import BadFilter, DataNotReady, Service, UnknownId

log = logging.getLogger("quillon.http")

# The paths that readers call.
ROUTES = {
    r"/api/health": "health",
    r"/api/meta": "meta",
    r"/api/objectives/(?P<objective>[^/]+)/measures": "measures",
    r"/api/status": "status",
    r"/api/signals/(?P<indicator>[^/]+)": "signals",
    r"/api/objectives/(?P<objective>[^/]+)/associations": "associations",
    r"/api/objectives/(?P<objective>[^/]+)/associations/(?P<indicator>[^/]+)/cells": "association_cells",
    r"/api/findings": "findings",
    r"/api/trust": "trust",
}
STATES = {UnknownId: 404, BadFilter: 422, DataNotReady: 503}


def answer(service: Service, target: str) -> tuple[int, object]:
    """State and body for a path with its query."""
    url = urlsplit(target)
    try:
        for pattern, name in ROUTES.items():
            if found := re.fullmatch(pattern, url.path.rstrip("/")):
                ask = getattr(service, name)
                asked = {k: unquote(v) for k, v in found.groupdict().items()}
                filters = dict(parse_qsl(url.query, keep_blank_values=True))
                if odd := sorted(set(filters) - (set(signature(ask).parameters) - set(asked))):
                    raise BadFilter(f"no filter {', '.join(odd)}")
                body = ask(**asked, **filters)
                return (503 if name == "health" and body["status"] != "ok" else 200), body
        raise UnknownId(f"no path {url.path}")
    except tuple(STATES) as e:
        return STATES[type(e)], {"error": type(e).__name__, "detail": str(e.args[0])}
    except Exception:  # the reader gets a number to ask about, the log has the rest
        number = uuid.uuid4().hex
        log.exception("request %s failed: %s", number, target)
        return 500, {"error": "InternalError", "request_id": number}


def server(service: Service, host: str = "127.0.0.1", port: int = 8000) -> ThreadingHTTPServer:
    """A server that is ready for serve_forever(); port 0 takes any free one."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            begun = time.perf_counter()
            state, body = answer(service, self.path)
            data = json.dumps(body, default=str).encode()
            self.send_response(state)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.send_header("Cache-Control", "no-store")  # tables change with every run
            self.end_headers()
            self.wfile.write(data)
            log.info("request", extra={"method": self.command, "path": self.path, "state": state, "ms": round(1000 * (time.perf_counter() - begun), 1)})

        def log_request(self, *args) -> None:
            """Logged with its time, once it is answered."""

        def log_message(self, form: str, *args) -> None:
            log.info(form, *args)

    return ThreadingHTTPServer((host, port), Handler)
