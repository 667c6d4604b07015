"""Which kind of source an address is."""

from __future__ import annotations

import json
import os
from urllib.parse import urlsplit

from .arrays import ArrayInfo
from .cog import open_cog
from .stac import cog_assets, is_http, list_http_assets, open_document, open_http
from .stores import LocalStore, checked, open_store
from .zarr import list_arrays, metadata, open_array

RASTER = (".tif", ".tiff")


class Group(ValueError):
    """The address is a group; ``arrays`` names what is in it."""

    def __init__(self, uri: str, arrays: list[str]):
        self.arrays = arrays
        super().__init__(f"{uri} is a group, choose an array: {', '.join(arrays)}")


def _path(uri: str) -> str:
    return urlsplit(uri).path.rstrip("/").lower() if "://" in uri else uri.rstrip("/").lower()


def _local_document(path: str) -> dict | None:
    if not os.path.isfile(path) or path.lower().endswith(RASTER):
        return None
    with open(path, "rb") as f:
        try:
            document = json.loads(f.read())
        except ValueError:
            return None
    return document if isinstance(document, dict) else None


def open_source(uri: str, bounds: dict | None = None, asset: str | None = None) -> ArrayInfo:
    """Describe the array at an address: Zarr, a raster, or a STAC document."""
    bounds = bounds or {}
    if is_http(uri) and not _path(uri).endswith((".zarr", *RASTER)):
        found = open_http(uri, bounds, asset)
        if found is not None:
            return found
    if "://" not in uri or uri.startswith("file:"):
        path = checked(uri)
        document = _local_document(path)
        if document is not None and document.get("type") in ("Feature", "FeatureCollection"):
            return open_document(uri, document, path, asset)
    store = open_store(uri)
    if _path(uri).endswith(RASTER):
        info = open_cog(uri, store)
        if info is None:
            raise FileNotFoundError(uri)
        return info
    if asset is not None and metadata(store) is None:
        store = store.child(asset)
    info = open_array(uri, store)
    if info is None:
        names = list_arrays(store)
        if names:
            raise Group(uri, names)
        raise FileNotFoundError(f"there is no array at {uri}")
    return info


def list_sources(uri: str) -> list[str]:
    """Arrays or assets of a group; empty for a single array."""
    if is_http(uri) and not _path(uri).endswith((".zarr", *RASTER)):
        try:
            return list_http_assets(uri)
        except (OSError, ValueError):
            pass
    elif not is_http(uri) and not uri.startswith("s3:"):
        document = _local_document(checked(uri))
        if document is not None:
            items = document.get("features") or [document]
            return cog_assets(items[0])
    store = open_store(uri) if not isinstance(uri, LocalStore) else uri
    return [] if _path(uri).endswith(RASTER) else list_arrays(store)
