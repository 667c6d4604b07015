"""Vector features: GeoJSON, whole or a feature per line, CSV points and Parquet, with geometry as WKB in ``geom``."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import from_geojson, from_wkt, point_wkb, to_wkb
from .stores import checked

#: So many properties become columns; the others, by name, share one.
SAMPLE_KEYS = 10_000
REST = "other_properties"


def geometry_to_wkb(text: str | None) -> bytes | None:
    if not text:
        return None
    g = json.loads(text)
    if g and g.get("type") == "Point":
        return point_wkb(*map(float, g["coordinates"][:2]))
    shapes = from_geojson(g)
    return to_wkb(shapes) if shapes else None


def _map_geometry(df: DataFrame, column: str, convert) -> DataFrame:
    """Replace a text column by its WKB as ``geom``, at the end."""
    names = [c for c in df.columns if c != column]
    schema = T.StructType([*[df.schema[c] for c in names], T.StructField("geom", T.BinaryType())])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index(column)
            geom = pa.array([convert(t) for t in batch.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(batch.num_columns) if i != at], geom], [*[n for n in batch.schema.names if n != column], "geom"])

    return df.select(*names, column).mapInArrow(part, schema)


def _kind(value) -> str:
    return {bool: "boolean", int: "bigint", float: "double", str: "string", type(None): "void"}.get(type(value), "json")


def _merge(a: str, b: str) -> str:
    if a == b or b == "void":
        return a
    if a == "void":
        return b
    return "double" if {a, b} == {"bigint", "double"} else "string"


def property_types(features: DataFrame) -> dict[str, str]:
    """Names and types of the first properties by name, one more than become columns; each type is that of all features."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str], None] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for k, v in (json.loads(text) if text else {}).items():
                    seen[(k, _kind(v))] = None
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in seen], pa.string()), pa.array([t for _, t in seen], pa.string())], ["k", "t"])

    pairs = features.select("properties").mapInArrow(part, "k string, t string")
    found = pairs.groupBy("k").agg(F.sort_array(F.collect_set("t")).alias("t")).orderBy("k").limit(SAMPLE_KEYS + 1).collect()
    out = {r["k"]: reduce(_merge, r["t"], "void") for r in found}
    return {k: "string" if t in ("void", "json") else t for k, t in out.items()}


def _rest(features: DataFrame, last: str, name: str) -> DataFrame:
    """Adds the properties whose names are after ``last`` as the text of a JSON object, sorted by name; null if a feature has none."""
    schema = T.StructType([*features.schema.fields, T.StructField(name, T.StringType())])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.names.index("properties")).to_pylist()
            rest = [{k: v for k, v in (json.loads(t) if t else {}).items() if k > last} for t in texts]
            rest = pa.array([json.dumps(r, sort_keys=True, ensure_ascii=False) if r else None for r in rest], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, rest], [*batch.schema.names, name])

    return features.mapInArrow(part, schema)


def read_geojson(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Properties as columns, then ``geom``.  ``lines``: a feature per line, which is read in parallel.

    With more than SAMPLE_KEYS properties the first by name are columns, and
    the others are a JSON object in the column ``other_properties``.
    """
    schema = "type string, features array<string>, geometry string, properties string"
    docs = spark.read.schema(schema).json(path, multiLine=not lines)
    inner = F.from_json("feature", "geometry string, properties string")
    nested = docs.where("features IS NOT NULL").select(F.explode("features").alias("feature")).select(inner.alias("f")).select("f.geometry", "f.properties")
    single = docs.where("type = 'Feature'").select("geometry", "properties")
    features = nested.unionByName(single)
    types = property_types(features)
    rest = []
    if len(types) > SAMPLE_KEYS:
        types = dict(list(types.items())[:SAMPLE_KEYS])
        name = REST
        while name in types:
            name += "_"
        features, rest = _rest(features, list(types)[-1], name), [name]
    typed = ", ".join(f"`{k.replace('`', '``')}` {t}" for k, t in types.items())
    if types:
        features = features.select(F.from_json("properties", typed).alias("p"), *rest, "geometry").select(*[F.col("p").getField(k).alias(k) for k in types], *rest, "geometry")
    else:
        features = features.select("geometry")
    return _map_geometry(features, "geometry", geometry_to_wkb)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """By the file's name: .geojson and .json, .geojsonl and .ndjson, .csv, .parquet."""
    path = checked(path) if "://" not in path else path
    name = path.lower().rstrip("/")
    if name.endswith((".geojsonl", ".ndjson", ".geojsons")):
        return read_geojson(spark, path, lines=True)
    if name.endswith((".geojson", ".json")):
        return read_geojson(spark, path)
    if name.endswith(".parquet"):
        return spark.read.parquet(path)
    if name.endswith(".csv"):
        df = spark.read.csv(path, header=True, inferSchema=True)
        wkt = next((c for c in df.columns if c.lower() in ("wkt", "geometry", "geom")), None)
        return _map_geometry(df, wkt, lambda t: to_wkb(from_wkt(t)) if t else None) if wkt else df
    raise ValueError(f"unsupported vector file {path}")
