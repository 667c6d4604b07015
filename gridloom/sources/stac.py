"""STAC documents: items are groups of rasters, collections of items are stacks in time."""

from __future__ import annotations

import json
import os
import urllib.error
import urllib.parse
import urllib.request
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import UTC, datetime
from urllib.parse import parse_qsl, urlencode, urljoin, urlsplit, urlunsplit

import numpy as np

from .arrays import ArrayInfo
from .cog import open_cog
from .stores import HttpStore, LocalStore, checked

MAX_PAGES = 1000
MAX_AREA = 1000.0
THREADS = 16


def is_http(uri: str) -> bool:
    return uri.startswith(("http://", "https://"))


def fetch_json(url: str, body: dict | None = None, timeout: float = 60) -> dict:
    request = urllib.request.Request(url, headers={"Accept": "application/json"})
    if body is not None:
        request.data = json.dumps(body).encode()
        request.add_header("Content-Type", "application/json")
    with urllib.request.urlopen(request, timeout=timeout) as reply:
        return json.loads(reply.read())


def json_or_none(url: str) -> dict | None:
    """None where there is nothing, or nothing that is JSON; any other failure is one."""
    try:
        return fetch_json(url)
    except urllib.error.HTTPError as e:
        # Servers that don't list say of a missing key that it is forbidden.
        if e.code in (400, 403, 404, 405, 410):
            return None
        raise
    except ValueError:
        return None


def is_cog_asset(asset: dict) -> bool:
    kind = str(asset.get("type") or "").lower()
    return "tiff" in kind or "cog" in kind or str(asset.get("href") or "").lower().endswith((".tif", ".tiff"))


def cog_assets(item: dict) -> list[str]:
    names = sorted(k for k, a in (item.get("assets") or {}).items() if isinstance(a, dict) and is_cog_asset(a))
    if not names:
        raise ValueError(f"STAC item {item.get('id', '<no id>')} has no COG assets")
    return names


def href(item: dict, asset: str) -> str:
    found = (item.get("assets") or {}).get(asset)
    if not found or not found.get("href"):
        raise ValueError(f"STAC item {item.get('id', '<no id>')} has no asset {asset}")
    return found["href"]


def seconds(text: str) -> float:
    """Whole seconds since 1970 of an RFC 3339 time."""
    at = datetime.fromisoformat(text)
    if at.tzinfo is None:
        raise ValueError(f"{text!r} has no time zone")
    return float(int(at.astimezone(UTC).timestamp() // 1))


def by_time(collection: dict) -> list[tuple[float, dict]]:
    """Items in the order of their datetime; every one must have it."""
    items = collection.get("features")
    if not items:
        raise ValueError("nothing to stack: the collection is empty")
    out = []
    for item in items:
        name, text = item.get("id", "<no id>"), (item.get("properties") or {}).get("datetime")
        if not isinstance(text, str):
            raise ValueError(f"item {name} says no datetime, so it has no place in the stack")
        try:
            out.append((seconds(text), item))
        except ValueError as e:
            raise ValueError(f"item {name} has no usable datetime: {e}") from e
    return sorted(out, key=lambda p: p[0])


def resolve(base: str, link: str) -> str:
    """A link relative to a document."""
    if is_http(link) or link.startswith(("s3://", "file:")) or os.path.isabs(link):
        return link
    return urljoin(base, link) if is_http(base) else os.path.normpath(os.path.join(os.path.dirname(base), link))


def open_raster(uri: str) -> ArrayInfo:
    store = HttpStore(uri) if is_http(uri) else LocalStore(checked(uri), check=False)
    info = open_cog(uri, store)
    if info is None:
        raise FileNotFoundError(uri)
    return info


def choose(names: list[str], asset: str | None, where: str) -> str:
    if asset is not None:
        if asset not in names:
            raise ValueError(f"no asset {asset!r} in {where}; there are: {', '.join(names)}")
        return asset
    if len(names) != 1:
        raise ValueError(f"{where} has several assets, choose one: {', '.join(names)}")
    return names[0]


@dataclass
class StackReader:
    """Chunk (t, ...) is chunk (...) of the t-th raster."""

    readers: list

    def read(self, at, part):
        got = self.readers[at[0]].read(at[1:], part[1:])
        return None if got is None else got[None]


def time_stack(uri: str, collection: dict, base: str, asset: str | None) -> ArrayInfo:
    """All items' rasters of one asset as an array with time in front."""
    items = by_time(collection)
    name = choose(cog_assets(items[0][1]), asset, uri)
    links = [resolve(base, href(item, name)) for _, item in items]
    with ThreadPoolExecutor(THREADS) as pool:
        rasters = list(pool.map(open_raster, links))
    first = rasters[0]
    for (_, item), r in zip(items, rasters, strict=True):
        same = (r.shape, r.chunk, r.dtype, r.crs, r.dims) == (first.shape, first.chunk, first.dtype, first.crs, first.dims)
        if not same or (r.scale, r.translation) != (first.scale, first.translation):
            raise ValueError(f"STAC item {item.get('id', '<no id>')} has another grid than the first one")
    lead = None if first.scale is None else [None]
    return ArrayInfo(
        uri, [len(items), *first.shape], [1, *first.chunk], first.dtype, ["time", *first.dims], StackReader([r.reader for r in rasters]),
        {"time": np.array([t for t, _ in items])}, lead and lead + first.scale, lead and lead + first.translation, first.fill, first.crs,
    ).validate()


def bbox_of(bounds: dict) -> list[float] | None:
    """west, south, east, north, if all four are bounded."""
    lon, lat = bounds.get("lon") or bounds.get("x"), bounds.get("lat") or bounds.get("y")
    if not lon or not lat or None in (*lon, *lat):
        return None
    return [lon[0], lat[0], lon[1], lat[1]]


def interval_of(bounds: dict) -> str | None:
    """The datetime interval of a time bound in seconds."""
    low, high = bounds.get("time") or (None, None)
    if low is None and high is None:
        return None
    text = lambda v: ".." if v is None else datetime.fromtimestamp(v, UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    return f"{text(low)}/{text(high)}"


def with_query(url: str, **extra: str | None) -> str:
    parts = urlsplit(url)
    query = [(k, v) for k, v in parse_qsl(parts.query) if k not in extra or extra[k] is None]
    return urlunsplit(parts._replace(query=urlencode(query + [(k, v) for k, v in extra.items() if v is not None], safe=",:/")))


def looks_like_search(url: str) -> bool:
    path = urlsplit(url).path.rstrip("/")
    return path.endswith(("/search", "/items")) or "/collections/" in path and path.endswith("/items")


def guard_search(bounds: dict) -> None:
    """A search must say where, and not everywhere."""
    box = bbox_of(bounds)
    if box is None:
        raise ValueError("a STAC search needs lat_min, lat_max, lon_min and lon_max")
    if (area := abs((box[2] - box[0]) * (box[3] - box[1]))) > MAX_AREA:
        raise ValueError(f"a STAC search over {area:g} square degrees; {MAX_AREA:g} at most")


def all_pages(url: str, first: dict) -> dict:
    """Follow rel=next; a page that fails, or comes again, is an error."""
    features, seen, page = list(first.get("features") or []), {url}, first
    for _ in range(MAX_PAGES):
        link = next((x for x in page.get("links") or [] if x.get("rel") == "next" and x.get("href")), None)
        if link is None:
            return {**first, "features": features}
        url = urljoin(url, link["href"])
        key = url + json.dumps(link.get("body") or {}, sort_keys=True)
        if key in seen:
            raise ValueError(f"the STAC pages go round in a circle at {url}")
        seen.add(key)
        page = fetch_json(url, link.get("body") if str(link.get("method")).upper() == "POST" else None)
        features += page.get("features") or []
    raise ValueError(f"more than {MAX_PAGES} STAC pages")


def open_document(uri: str, document: dict, base: str, asset: str | None) -> ArrayInfo:
    kind = document.get("type")
    if kind == "FeatureCollection":
        return time_stack(uri, document, base, asset)
    if kind == "Feature":
        name = choose(cog_assets(document), asset, uri)
        return open_raster(resolve(base, href(document, name)))
    raise ValueError(f"{uri} is a {kind or 'document'} that isn't a STAC item or collection of items")


def open_http(uri: str, bounds: dict, asset: str | None) -> ArrayInfo | None:
    """A STAC document behind a URL, or the asset that a URL ends in; None if it is neither."""
    search = looks_like_search(uri)
    if search:
        guard_search(bounds)
    box = bbox_of(bounds)
    url = with_query(uri, bbox=",".join(f"{v:g}" for v in box) if box else None, datetime=interval_of(bounds)) if search else uri
    document = fetch_json(url) if search else json_or_none(url)
    if isinstance(document, dict) and document.get("type") in ("Feature", "FeatureCollection"):
        if document["type"] == "FeatureCollection":
            document = all_pages(url, document)
        return open_document(uri, document, url, asset)
    above, _, last = uri.rstrip("/").rpartition("/")
    document = json_or_none(above)
    if isinstance(document, dict) and document.get("type") == "Feature" and last in (document.get("assets") or {}):
        return open_document(uri, document, above, last)
    return None


def list_http_assets(uri: str) -> list[str]:
    document = fetch_json(uri)
    items = document.get("features") or [document]
    return cog_assets(items[0])
