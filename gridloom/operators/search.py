"""Search in STAC catalogues: plain requests by the driver."""

from __future__ import annotations

from ..sources.stac import fetch_json, is_cog_asset

LIMIT = 10


def search_body(collection: str, bbox: str | None = None, datetime: str | None = None, limit: int = LIMIT) -> dict:
    body: dict = {"collections": [collection], "limit": limit}
    if bbox:
        try:
            numbers = [float(x) for x in bbox.split(",")]
        except ValueError as e:
            raise ValueError(f"bbox {bbox!r} isn't four numbers") from e
        if len(numbers) != 4:
            raise ValueError(f"bbox {bbox!r} isn't four numbers")
        body["bbox"] = numbers
    if datetime:
        body["datetime"] = datetime
    return body


def supported(asset: dict) -> bool:
    kind, href = str(asset.get("type") or "").lower(), str(asset.get("href") or "").lower()
    return "zarr" in kind or ".zarr" in href or is_cog_asset(asset)


def results(reply: dict) -> list[dict]:
    """id and uri of the features that link to themselves and have an asset that can be read."""
    out = []
    for item in reply.get("features") or []:
        own = next((x.get("href") for x in item.get("links") or [] if x.get("rel") == "self"), None)
        if own and any(supported(a) for a in (item.get("assets") or {}).values()):
            out.append({"id": item.get("id"), "uri": own})
    return out


def collections(api: str) -> list[dict]:
    """Collections of which some asset can be read."""
    out = []
    for c in fetch_json(f"{api.rstrip('/')}/collections").get("collections") or []:
        assets = [*(c.get("assets") or {}).values(), *(c.get("item_assets") or {}).values()]
        if any(supported(a) for a in assets):
            out.append({"id": c.get("id"), "title": c.get("title") or c.get("id")})
    return out


def search(api: str, collection: str, bbox: str | None = None, datetime: str | None = None, limit: int = LIMIT) -> list[dict]:
    """Items of a collection; its own document's assets if there are none."""
    found = results(fetch_json(f"{api.rstrip('/')}/search", search_body(collection, bbox, datetime, limit)))
    if found:
        return found
    document = fetch_json(f"{api.rstrip('/')}/collections/{collection}")
    return [{"id": k, "uri": a["href"]} for k, a in sorted((document.get("assets") or {}).items()) if supported(a) and a.get("href")]
