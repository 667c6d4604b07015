"""A folder over HTTP: byte ranges, and a small STAC catalogue of the items in it.

For trying remote reads without a network; it serves what its folder holds
and counts what it sends.
"""

from __future__ import annotations

import json
import os
import threading
from functools import partial
from http.server import SimpleHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlsplit

CATALOGUE = "catalogue.json"


class _Handler(SimpleHTTPRequestHandler):
    protocol_version = "HTTP/1.1"

    def __init__(self, *args, owner: FolderServer, **kwargs):
        self.owner = owner
        super().__init__(*args, directory=owner.folder, **kwargs)

    def log_message(self, *args) -> None:
        pass

    def send(self, data: bytes, status: int = 200, kind: str = "application/octet-stream") -> None:
        self.owner.count(self.path, len(data))
        self.send_response(status)
        self.send_header("Content-Type", kind)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)

    def send_json(self, document) -> None:
        self.send(json.dumps(document).encode(), kind="application/json")

    def catalogue(self) -> dict:
        with open(os.path.join(self.owner.folder, CATALOGUE)) as f:
            return json.load(f)

    def do_POST(self) -> None:
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        wanted = body.get("collections") or []
        items = [i for i in self.catalogue().get("items", []) if not wanted or i.get("collection") in wanted]
        self.send_json({"type": "FeatureCollection", "features": items[: body.get("limit", 10)], "links": []})

    def do_GET(self) -> None:
        parts = urlsplit(self.path)
        if parts.path == "/collections":
            return self.send_json({"collections": self.catalogue().get("collections", [])})
        if parts.path == "/search":
            # One item a page.
            items = self.catalogue().get("items", [])
            page = int(parse_qs(parts.query).get("page", ["0"])[0])
            links = [{"rel": "next", "href": f"/search?page={page + 1}"}] if page + 1 < len(items) else []
            return self.send_json({"type": "FeatureCollection", "features": items[page : page + 1], "links": links})
        path = os.path.join(self.owner.folder, parts.path.lstrip("/"))
        if self.owner.locked(parts.path):
            return self.send(b"", 403)
        if not os.path.isfile(path):
            return self.send(b"", 404)
        size = os.path.getsize(path)
        first, last, status = 0, size - 1, 200
        if span := self.headers.get("Range"):
            a, _, b = span.removeprefix("bytes=").partition("-")
            first, last = (max(0, size - int(b)), size - 1) if not a else (int(a), min(int(b), size - 1) if b else size - 1)
            status = 206
        with open(path, "rb") as f:
            f.seek(first)
            self.send(f.read(max(0, last - first + 1)), status)


class FolderServer:
    """Serves a folder until the process ends; ``url`` says where."""

    def __init__(self, folder: str, host: str = "127.0.0.1"):
        self.folder, self.forbidden = folder, set()
        self.paths: list[str] = []
        self.bytes = 0
        self._lock = threading.Lock()
        self._http = ThreadingHTTPServer((host, 0), partial(_Handler, owner=self))
        self._http.daemon_threads = True
        threading.Thread(target=self._http.serve_forever, daemon=True).start()
        self.url = f"http://{host}:{self._http.server_address[1]}"

    def count(self, path: str, n: int) -> None:
        with self._lock:
            self.paths.append(path)
            self.bytes += n

    def locked(self, path: str) -> bool:
        return path in self.forbidden
