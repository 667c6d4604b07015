"""Byte stores: local folders, HTTP servers with byte ranges, object stores."""

from __future__ import annotations

import os
import urllib.error
import urllib.request
from dataclasses import dataclass
from urllib.parse import urljoin, urlparse

#: Folders that local paths must be in; unset: the working folder.
ALLOW = "GRIDLOOM_ALLOW_PATH"


class Forbidden(PermissionError):
    pass


def local_path(uri: str) -> str:
    return urlparse(uri).path if uri.startswith("file:") else uri


def checked(uri: str) -> str:
    """The canonical path, if it is in an allowed folder (several: separated by ``:``)."""
    path = os.path.realpath(local_path(uri))
    roots = [os.path.realpath(r) for r in (os.environ.get(ALLOW) or os.getcwd()).split(os.pathsep) if r]
    if not any(os.path.commonpath([path, r]) == r for r in roots):
        raise Forbidden(f"{uri} is outside the allowed folders; set {ALLOW}")
    return path


def permit(folders: str | None) -> None:
    """Allow what the driver allows, in a process that it has started."""
    if folders:
        os.environ[ALLOW] = folders


@dataclass
class Traffic:
    """What a store has read, for tests and reports."""

    requests: int = 0
    bytes: int = 0


class Store:
    """Keys below a root.  ``get`` gives None for a key that isn't there."""

    def __init__(self) -> None:
        self.traffic = Traffic()

    def get(self, key: str, start: int | None = None, length: int | None = None) -> bytes | None:
        """All of it; ``length`` bytes from ``start``; or the last ``-start`` bytes."""
        data = self._get(key, start, length)
        self.traffic.requests += 1
        self.traffic.bytes += len(data or b"")
        return data

    def _get(self, key: str, start: int | None, length: int | None) -> bytes | None:
        raise NotImplementedError

    def probe(self, key: str) -> bytes | None:
        """``get`` of what may or may not be there: servers that don't list say of a missing key that it is forbidden."""
        try:
            return self.get(key)
        except Forbidden:
            return None

    def list(self, key: str = "") -> list[str]:
        """Names directly below; empty where a store can't list."""
        return []

    def child(self, path: str) -> Store:
        raise NotImplementedError

    def parent(self) -> Store | None:
        return None


class LocalStore(Store):
    def __init__(self, root: str, check: bool = True):
        super().__init__()
        self.root = checked(root) if check else os.path.realpath(local_path(root))

    def _get(self, key, start, length):
        try:
            with open(os.path.join(self.root, key) if key else self.root, "rb") as f:
                if start is None:
                    return f.read()
                f.seek(start, os.SEEK_END if start < 0 else os.SEEK_SET)
                return f.read(-start if start < 0 else length)
        except (FileNotFoundError, NotADirectoryError, IsADirectoryError):
            return None

    def list(self, key=""):
        path = os.path.join(self.root, key)
        return sorted(os.listdir(path)) if os.path.isdir(path) else []

    def child(self, path):
        return LocalStore(os.path.join(self.root, path), check=False)

    def parent(self):
        return LocalStore(os.path.dirname(self.root), check=False)


class HttpStore(Store):
    """Keys are resolved below the whole URL, whose query string they keep."""

    def __init__(self, url: str, timeout: float = 60):
        super().__init__()
        self.url, self.timeout = url, timeout

    def _url(self, key: str) -> str:
        if not key:
            return self.url
        base, sep, query = self.url.partition("?")
        return base.rstrip("/") + "/" + key + sep + query

    def _get(self, key, start, length):
        request = urllib.request.Request(self._url(key))
        if start is not None:
            request.add_header("Range", f"bytes={start}" if start < 0 else f"bytes={start}-{'' if length is None else start + length - 1}")
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as reply:
                data = reply.read()
                if start is not None and reply.status == 200:  # no ranges there
                    data = data[start:] if start < 0 or length is None else data[start : start + length]
                return data
        except urllib.error.HTTPError as e:
            if e.code in (404, 410):
                return None
            if e.code in (401, 403):
                raise Forbidden(f"{self._url(key)} may not be read (HTTP {e.code}); if it isn't there, the server should say 404") from e
            if e.code == 416:
                return b""
            raise

    def child(self, path):
        return HttpStore(self._url(path), self.timeout)

    def parent(self):
        return HttpStore(urljoin(self.url.rstrip("/"), ".").rstrip("/"), self.timeout)


class ArrowStore(Store):
    """S3 and other object stores, through Arrow's file systems."""

    def __init__(self, uri: str):
        super().__init__()
        from pyarrow import fs

        self.uri = uri.rstrip("/")
        self.fs, self.root = fs.FileSystem.from_uri(self.uri)

    def _get(self, key, start, length):
        try:
            with self.fs.open_input_file(f"{self.root}/{key}" if key else self.root) as f:
                if start is None:
                    return f.read()
                f.seek(max(0, f.size() + start) if start < 0 else start)
                return f.read(-start if start < 0 else length)
        except FileNotFoundError:
            return None

    def list(self, key=""):
        from pyarrow import fs

        found = self.fs.get_file_info(fs.FileSelector(f"{self.root}/{key}".rstrip("/"), allow_not_found=True))
        return sorted(i.base_name for i in found)

    def child(self, path):
        return ArrowStore(f"{self.uri}/{path}")

    def parent(self):
        return ArrowStore(self.uri.rpartition("/")[0])


def open_store(uri: str) -> Store:
    scheme = urlparse(uri).scheme
    if scheme in ("http", "https"):
        return HttpStore(uri)
    if scheme in ("", "file"):
        return LocalStore(uri)
    return ArrowStore(uri)
