"""Settings in layers: the user's file, then the folder's, then the environment."""

from __future__ import annotations

import os
import tomllib
from dataclasses import dataclass, field, fields
from pathlib import Path

PREFIX = "GRIDLOOM_"
FILE = "gridloom.toml"

#: Public catalogues known by name.
PROVIDERS = {
    "earth-search": "https://earth-search.aws.element84.com/v1",
    "planetary-computer": "https://planetarycomputer.microsoft.com/api/stac/v1",
    "copernicus": "https://stac.dataspace.copernicus.eu/v1",
}


@dataclass
class Config:
    s3_region: str | None = None
    s3_access_key_id: str | None = None
    s3_secret_access_key: str | None = None
    s3_endpoint: str | None = None
    allow_path: str | None = None
    providers: dict[str, str] = field(default_factory=dict)

    def all_providers(self) -> dict[str, str]:
        return PROVIDERS | self.providers

    def spark_settings(self) -> dict[str, str]:
        """What Spark's S3 connector needs to know."""
        names = {"s3_region": "endpoint.region", "s3_access_key_id": "access.key", "s3_secret_access_key": "secret.key", "s3_endpoint": "endpoint"}
        return {f"spark.hadoop.fs.s3a.{v}": got for k, v in names.items() if (got := getattr(self, k))}


def load(home: str | None = None, here: str | None = None, env: dict[str, str] | None = None) -> Config:
    env = dict(os.environ) if env is None else env
    merged: dict = {}
    base = Path(home or env.get("XDG_CONFIG_HOME") or Path.home() / ".config")
    for path in (base / "gridloom" / "config.toml", Path(here or os.getcwd()) / FILE):
        if path.is_file():
            got = tomllib.loads(path.read_text())
            merged["providers"] = merged.get("providers", {}) | got.pop("providers", {})
            merged |= got
    known = {f.name for f in fields(Config)}
    for key, value in env.items():
        name = key.removeprefix(PREFIX).lower()
        if key.startswith(PREFIX) and name in known and name != "providers":
            merged[name] = value
    return Config(**{k: v for k, v in merged.items() if k in known})
