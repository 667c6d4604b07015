import json
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom import guard
from gridloom.cli import main
from gridloom.config import load
from gridloom.functions.geometry import from_wkt, point_wkb, to_wkb
from gridloom.operators.extract import extract, plan
from gridloom.operators.ingest import ingest
from gridloom.operators.plots import draw_heatmap, draw_histogram, draw_line, heatmap, histogram, line
from gridloom.operators.resample import detect, resample
from gridloom.operators.timeseries import point_timeseries
from gridloom.operators.zonal import zonal_stats
from gridloom.sources.cells import read_geo
from gridloom.sources.resolve import open_source
from gridloom.sources.stores import ArrowStore
from gridloom.sources.vector import read_features
from gridloom.sources.zarr_sink import export_zarr
from gridloom.tools import TimedOut, Tools, serve

TWELVE = [(t, lat, lon, float(2 + 4 * k + 2 * i + j)) for k, t in enumerate((0, 86400, 172800)) for i, lat in enumerate((10.0, 20.0)) for j, lon in enumerate((30.0, 40.0))]
SQUARE = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"name": "box", "a": 1}, "geometry": {"type": "Polygon", "coordinates": [[[31, 9], [41, 9], [41, 21], [31, 21], [31, 9]]]}}]}


@pytest.fixture
def grid(spark, folder):
    df = spark.createDataFrame(TWELVE, "time long, lat double, lon double, value double")
    export_zarr(df, str(folder / "g.zarr"), chunks={"time": 2, "lat": 1, "lon": 2}, coords=True)
    (folder / "p.geojson").write_text(json.dumps(SQUARE))
    df.withColumnRenamed("value", "air_temperature").write.parquet(str(folder / "e.parquet"))
    return folder


def test_resample_values_and_refusals(spark):
    rows = [(0, 1.0, 1.0, 2.0), (86400, 1.0, 1.0, 4.0), (31536000, 1.0, 1.0, 10.0)]
    df = spark.createDataFrame(rows, "time long, lat double, lon double, air_temperature double")
    assert sorted(r["value"] for r in resample(df, "year", "AVG").collect()) == [3.0, 10.0]
    assert [r["value"] for r in resample(df, "year", "mode").orderBy("time").collect()] == [2.0, 10.0]
    for freq, agg in (("decade", "avg"), ("year", "first")):
        with pytest.raises(ValueError):
            resample(df, freq, agg)
    c = detect(df.toDF("relative", "lat", "lon", "time"))
    assert (c.time, c.lat, c.value) == ("time", "lat", "relative")


def test_zonal_rules(spark, grid):
    uri, shapes = str(grid / "g.zarr"), str(grid / "p.geojson")
    assert [tuple(r) for r in zonal_stats(spark, uri, shapes, "max").collect()] == [(1, "box", 13.0)]
    touched = zonal_stats(spark, uri, shapes, "mean", "all_touched").first()["metric"]
    assert touched == np.mean([r[3] for r in TWELVE])
    by_time = zonal_stats(spark, uri, shapes, "min", by_time=True).orderBy("time").collect()
    assert [(r["time"], r["metric"]) for r in by_time] == [(0.0, 3.0), (86400.0, 7.0), (172800.0, 11.0)]
    for metric, convention in (("max", "area_weighted"), ("count", "area_weighted"), ("median", "centroid"), ("max", "nearest")):
        with pytest.raises(ValueError):
            zonal_stats(spark, uri, shapes, metric, convention)


@pytest.mark.parametrize("held", [1 << 27, 0])
def test_zonal_paths_agree(spark, folder, monkeypatch, held):
    """Columns of many chunks, footprints dealt out to several tasks, chunks read again, many properties."""
    rng = np.random.default_rng(9)
    cells = [(t, float(y), float(x), float(rng.integers(100))) for t in range(40) for y in range(9) for x in range(9)]
    df = spark.createDataFrame(cells, "time long, lat double, lon double, value double")
    export_zarr(df, str(folder / "deep.zarr"), chunks={"time": 2, "lat": 4, "lon": 9}, coords=True)
    corners = [(k, *(rng.uniform(-1, 7, 2) + 0.01)) for k in range(60)]
    names = [f"c{k}" for k in range(10)]
    shapes = spark.createDataFrame([(k, *[k] * 10, to_wkb(from_wkt(f"POLYGON(({x} {y},{x + 2} {y},{x + 2} {y + 2},{x} {y + 2},{x} {y}))"))) for k, x, y in corners], f"id int, {', '.join(f'{n} int' for n in names)}, geom binary")
    want = {k: v for k, x, y in corners if (v := [c[3] for c in cells if x < c[2] < x + 2 and y < c[1] < y + 2])}
    monkeypatch.setattr("gridloom.operators.columns.PER_TASK", 1)
    monkeypatch.setattr("gridloom.operators.columns.FEW_BYTES", -1)
    monkeypatch.setattr("gridloom.operators.zonal.HELD_BYTES", held)
    for features in (shapes, shapes.select("id", "geom")):
        for metric, f in (("max", max), ("mean", lambda v: sum(v) / len(v)), ("count", len)):
            got = {r["id"]: r["metric"] for r in zonal_stats(spark, str(folder / "deep.zarr"), features, metric).collect()}
            assert got == pytest.approx({k: f(v) for k, v in want.items()})


def test_extract_reads_only_chunks_with_footprints(spark, folder):
    a = np.arange(60 * 60, dtype="f8").reshape(60, 60)
    df = spark.createDataFrame([(float(y), float(x), float(a[y, x])) for y in range(60) for x in range(60)], "lat double, lon double, value double")
    export_zarr(df, str(folder / "wide.zarr"), chunks={"lat": 10, "lon": 10}, coords=True)
    for y in range(6):
        for x in range(6):
            if (y, x) not in ((0, 0), (5, 5)):
                (folder / "wide.zarr" / "c" / str(y) / str(x)).write_bytes(b"not a chunk: reading it fails")
    far = [f"POLYGON(({k} {k},{k + 2.5} {k},{k + 2.5} {k + 2.5},{k} {k + 2.5},{k} {k}))" for k in (3.2, 53.2)]
    shapes = spark.createDataFrame([(i, to_wkb(from_wkt(w))) for i, w in enumerate(far)], "value int, geom binary")
    got = sorted((r["feature_value"], r["value"]) for r in extract(spark, str(folder / "wide.zarr"), shapes).collect())
    assert got == sorted((i, float(a[y, x])) for i, k in enumerate((4, 54)) for y in (k, k + 1) for x in (k, k + 1))


def test_long_axes_are_read_or_refused(spark, folder, monkeypatch):
    df = spark.range(1_000_001).selectExpr("cast(id as double) / 4 as t", "cast(id as double) as value")
    export_zarr(df, str(folder / "long.zarr"), chunks={"t": 250_000}, coords=True)
    got = read_geo(spark, str(folder / "long.zarr"), t_min=249_999.5).collect()
    assert sorted((r["t"], r["value"]) for r in got) == [(k / 4, float(k)) for k in range(999_998, 1_000_001)]
    monkeypatch.setattr("gridloom.sources.zarr.MAX_COORDS", 1_000_000)
    with pytest.raises(ValueError, match="1000000 at most"):
        open_source(str(folder / "long.zarr"))


def test_object_stores(folder):
    """Through Arrow's file systems, as for S3: here the local one."""
    (folder / "k").write_bytes(bytes(range(100)))
    (folder / "sub").mkdir()
    store = ArrowStore(f"file://{folder}")
    assert store.get("k", 10, 5) == bytes(range(10, 15)) and store.get("k", -3) == bytes([97, 98, 99]) and store.get("k") == bytes(range(100))
    assert store.get("none") is None and store.list() == ["k", "sub"] and store.child("sub").get("x") is None and store.child("sub").parent().get("k", 0, 1) == b"\0"


def test_equal_properties_merge_unless_told_apart(spark, grid):
    one = to_wkb(from_wkt("POLYGON((29 9,31 9,31 11,29 11,29 9))"))
    two = to_wkb(from_wkt("POLYGON((39 19,41 19,41 21,39 21,39 19))"))
    empty = to_wkb(from_wkt("POLYGON((0 0,1 0,1 1,0 0))"))
    df = spark.createDataFrame([("a", one), ("a", two), ("b", empty), ("c", None)], "name string, geom binary")
    uri = str(grid / "g.zarr")
    assert [(r["name"], r["metric"]) for r in zonal_stats(spark, uri, df, "count").collect()] == [("a", 6)]
    assert sorted(r["metric"] for r in zonal_stats(spark, uri, df, "max", by_feature=True).collect()) == [10.0, 13.0]


def test_extract_overlaps_names_and_plan(spark, grid):
    wide = to_wkb(from_wkt("POLYGON((0 0,100 0,100 100,0 100,0 0))"))
    df = spark.createDataFrame([("x", 1.0, wide), ("y", 2.0, wide)], "value string, lat double, geom binary")
    out = extract(spark, str(grid / "g.zarr"), df)
    assert out.columns == ["time", "lat", "lon", "value", "feature_value", "feature_lat"] and out.count() == 24
    assert extract(spark, str(grid / "g.zarr"), df, pins="time=1").count() == 8
    assert extract(spark, str(grid / "g.zarr"), df.limit(0)).count() == 0
    got = plan(str(grid / "g.zarr"), (0, 15, 100, 25))
    assert (got.chunks, got.megabytes) == (2, 2 * 4 * 8 / 1e6)


def test_point_series(spark, grid):
    uri = str(grid / "g.zarr")
    near = [r["value"] for r in point_timeseries(spark, uri, 11, 31).collect()]
    assert near == [2.0, 6.0, 10.0]
    exact = [r["value"] for r in point_timeseries(spark, uri, 10, 30, "idw").collect()]
    assert np.allclose(exact, near, atol=1e-6)
    assert point_timeseries(spark, uri, 99, 99).first()["value"] == 5.0
    with pytest.raises(ValueError):
        point_timeseries(spark, uri, 1, 1, "cubic")


def test_plots(spark, grid):
    df = spark.read.parquet(str(grid / "e.parquet"))
    bins = [(r["bin_idx"], r["freq"]) for r in histogram(df).collect()]
    assert bins == [(0, 2), *[(k, 1) for k in range(1, 11)]]
    assert draw_histogram(histogram(df).collect()).splitlines()[1].split()[:3] == ["0", "2", "16.7%"]
    means = [round(r["mean"], 2) for r in heatmap(df).collect()]
    assert means == [6.0, 7.0, 8.0, 9.0]
    assert draw_heatmap(heatmap(df).collect(), 10, 20, 30, 40, "v").splitlines()[2:4] == ["69", "03"]
    values = [r["mean"] for r in line(df).collect()]
    assert values == [r[3] for r in TWELVE] and "2 to 13, 12 points" in draw_line(values)
    assert [r["freq"] for r in histogram(df, pins={"time": 0}).collect()] == [1, 1, 1, 1]
    assert [r["bin_idx"] for r in histogram(df.withColumn("air_temperature", F.lit(1.0))).collect()] == [0]
    grouped = histogram(df, group="lat").collect()
    assert len({x.split()[0] for x in draw_histogram(grouped, True).splitlines()[1:]}) == 2
    many = spark.range(1000).selectExpr("id time", "1.0D lat", "1.0D lon", "cast(id as double) v")
    assert [r["mean"] for r in line(many, "v").collect()][:2] == [4.5, 14.5]


def test_vectors_and_ingest(spark, folder):
    points = [{"type": "Feature", "properties": {"x": i % 2, "y": i // 2, "value": i + 1.0, "tag": None}, "geometry": {"type": "Point", "coordinates": [i, i]}} for i in range(4)]
    (folder / "v.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": points}))
    (folder / "v.ndjson").write_text("\n".join(map(json.dumps, points)))
    wide = {"type": "Feature", "properties": {f"k{i:05}": i for i in range(20_000)}, "geometry": points[0]["geometry"]}
    (folder / "wide.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [wide]}))
    got = read_features(spark, str(folder / "wide.geojson")).select("k00000", "k09999", "other_properties").first()
    assert got[:2] == (0, 9999) and json.loads(got[2]) == {f"k{i:05}": i for i in range(10_000, 20_000)}
    for name in ("v.geojson", "v.ndjson"):
        df = read_features(spark, str(folder / name))
        assert dict(df.dtypes) == {"tag": "string", "value": "double", "x": "bigint", "y": "bigint", "geom": "binary"} and df.count() == 4
    (folder / "t.csv").write_text("lon,lat,value\n0,0,1\n0,1,2\n1,0,3\n1,1,4\n")
    got = ingest(spark, str(folder / "t.csv"), str(folder / "t.zarr"))
    assert got["shape"] == [2, 2]
    assert [r["value"] for r in read_geo(spark, str(folder / "t.zarr")).orderBy("lon", "lat").collect()] == [1, 2, 3, 4]
    for bad in ("nonsense", "[1]"):
        with pytest.raises(ValueError):
            ingest(spark, str(folder / "t.csv"), str(folder / "u.zarr"), chunks=bad)
    (folder / "w.csv").write_text('name,wkt\na,"POLYGON((0 0,1 0,1 1,0 0))"\n')
    assert read_features(spark, str(folder / "w.csv")).columns == ["name", "geom"]
    with pytest.raises(ValueError):
        read_features(spark, str(folder / "x.shp"))


def test_no_property_is_lost_past_the_limit(spark, folder, monkeypatch):
    kinds = [{"a": 1, "b": 1, "c": 1, "d": 1, "é": "x"}, {"a": 1.5, "b": "s", "c": None, "e": {"z": [True]}}, {"a": None, "b": 2.5, "c": 3}, None]
    rows = [{"type": "Feature", "properties": p, "geometry": {"type": "Point", "coordinates": [i, i]}} for i, p in enumerate(kinds)]
    (folder / "wide.ndjson").write_text("\n".join(map(json.dumps, rows)))
    for limit, types in ((3, {"a": "double", "b": "string", "c": "bigint", "other_properties": "string"}), (6, {"a": "double", "b": "string", "c": "bigint", "d": "bigint", "e": "string", "é": "string"})):
        monkeypatch.setattr("gridloom.sources.vector.SAMPLE_KEYS", limit)
        df = read_features(spark, str(folder / "wide.ndjson"))
        assert dict(df.dtypes) == types | {"geom": "binary"}
        got = {r["geom"]: r for r in df.collect()}
        got = [got[point_wkb(float(i), float(i))] for i in range(4)]
        assert [r["a"] for r in got] == [1.0, 1.5, None, None] and [r["b"] for r in got] == ["1", "s", "2.5", None] and [r["c"] for r in got] == [1, None, 3, None]
        if limit == 3:
            assert [r["other_properties"] and json.loads(r["other_properties"]) for r in got] == [{"d": 1, "é": "x"}, {"e": {"z": [True]}}, None, None]


@pytest.mark.parametrize("sql", ["SELECT 1", "select 'DROP x; y';", "WITH a AS (SELECT 1) SELECT * FROM a", "DESCRIBE t", "SHOW TABLES", "VALUES (1)", "CREATE TEMP VIEW v AS SELECT 1", "create or replace temporary table v as select 1", "SET VARIABLE x = 1", "EXPLAIN SELECT 1", "SELECT a.copy AS load FROM a -- DROP x"])
def test_guard_accepts(spark, sql):
    guard.check(sql, spark)


@pytest.mark.parametrize("sql", ["", ";", "SELECT 1; SELECT 2", "DROP TABLE t", "INSERT INTO t VALUES (1)", "CREATE TABLE t AS SELECT 1", "SET spark.x = 1", "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a", "EXPLAIN DROP\tTABLE t", "COPY t TO 'x'", "ADD JAR 'x'", "SELECT * FROM parquet.`/etc`", "CREATE TEMP VIEW v USING csv OPTIONS (path '/etc/passwd')", "PRAGMA x=1", "CACHE TABLE t"])
def test_guard_rejects(spark, sql):
    with pytest.raises(guard.Rejected):
        guard.check(sql, spark)


REACHING = [
    "SELECT * FROM `text`.`/etc/passwd`", "CREATE TEMP VIEW v AS SELECT * FROM `csv`.`/etc/passwd`", "SELECT reflect('java.lang.System', 'getenv', 'PATH')",
    "SELECT 1 WHERE EXISTS (SELECT JAVA_METHOD('java.util.UUID', 'randomUUID'))", "WITH a AS (SELECT * FROM `json`.`/x`) SELECT 1", "EXPLAIN SELECT * FROM `orc`.`/x`",
    "SELECT sum(a) OVER w FROM t WINDOW w AS (ORDER BY (SELECT max(value) FROM `text`.`/etc/passwd`))", "DESCRIBE `parquet`.`/x`", "SELECT * FROM identifier('text.`/etc/passwd`')",
    "SELECT TRANSFORM (a) USING 'cat' FROM t", "EXECUTE IMMEDIATE 'DROP TABLE t'", "BEGIN SELECT 1; END", "DECLARE VARIABLE x STRING DEFAULT reflect('a', 'b')", "SELECT * FROM t LATERAL VIEW reflect('a') x",
    "SELECT * FROM a, LATERAL (SELECT * FROM `text`.`/x`)", "FROM t INSERT INTO u SELECT *", "CREATE VIEW v AS SELECT 1",
]


@pytest.mark.parametrize("sql", REACHING)
def test_guard_keeps_files_and_the_jvm_out(spark, sql):
    with pytest.raises(guard.Rejected):
        guard.check(sql, spark)


@pytest.mark.parametrize("sql", ["SELECT * FROM default.t", "SELECT a, count(*) FROM t GROUP BY ALL HAVING count(*) > 1", "SELECT sum(a) OVER w FROM t WINDOW w AS (ORDER BY b)", "SELECT * FROM read_geo('x', lat_min => 1D)", "SELECT * FROM t LATERAL VIEW explode(a) e", "TABLE t", "FROM t SELECT a", "SELECT a FROM t UNION SELECT b FROM u EXCEPT SELECT 1", "SELECT * FROM t |> WHERE a > 1", "DECLARE VARIABLE x INT DEFAULT 3", "SHOW COLUMNS IN t"])
def test_guard_lets_queries_through(spark, sql):
    assert guard.check(sql, spark).text == sql


def test_tools(spark, grid):
    uri, tools = str(grid / "g.zarr"), Tools(spark)
    assert tools.describe_dataset(uri)["metadata"][0]["array_shape"] == "[3, 2, 2]"
    assert tools.estimate_cost(uri, {"lat_min": 15, "lat_max": 25, "lon_min": 0, "lon_max": 50})["estimate"] == [{"total_chunks": 2, "total_bytes": 64}]
    got = tools.read_region(uri, time={"time_min": 86400}, limit=3)
    assert (got["row_count"], len(got["rows"]), got["truncated"]) == (8, 3, True)
    again = tools.run_sql(f"SELECT count(*) AS n, max(value) AS m FROM {got['table_handle']}")
    assert again["rows"] == [[8, 13.0]]
    assert tools.run_sql("CREATE TEMP TABLE mine AS SELECT 1 AS a") == {"status": "ok"}
    assert "mine" in [t["name"] for t in tools.list_tables()["tables"]]
    assert tools.describe_table("mine")["sample"] == [{"a": 1}]
    assert tools.zonal_stats(uri, str(grid / "p.geojson"), "max")["rows"] == [[1, "box", 13.0]]
    assert tools.extract_point_timeseries(uri, 10, 30)["method"] == "nearest"
    for bad in (lambda: tools.describe_table("a b"), lambda: tools.run_sql("DROP VIEW mine")):
        with pytest.raises(ValueError):
            bad()
    assert tools.run_sql("SELECT CAST(1e20 AS DECIMAL(22,0)) AS d, DOUBLE('NaN') AS n, 9223372036854775807 AS i")["rows"] == [["100000000000000000000", None, 2**63 - 1]]
    lines = []
    serve([json.dumps({"id": 1, "method": "tools/list"}), json.dumps({"id": 2, "method": "tools/call", "params": {"name": "run_sql", "arguments": {"sql": "DROP TABLE x"}}}), json.dumps({"id": 3, "method": "nope"}), json.dumps({"method": "note"})], lines.append, tools)
    got = [json.loads(x) for x in lines]
    assert len(got[0]["result"]["tools"]) == 8 and got[1]["result"]["isError"] and "error" in got[2] and len(got) == 3


def test_slow_calls_are_cancelled(spark):
    tools = Tools(spark, timeout=1.0)
    with pytest.raises(TimedOut):
        tools.run_sql("SELECT count(*) AS n FROM range(0, 2000000) a JOIN range(0, 2000000) b ON a.id <> b.id + 0.5")


def test_jobs_begun_after_the_time_are_cancelled(spark):
    """A call that has no job yet when its time is over, as in a session that plans slowly."""
    tools = Tools(spark, timeout=0.1)

    def work():
        time.sleep(1.2)
        spark.sparkContext.parallelize(range(2), 2).foreach(lambda _: time.sleep(8))
        return {}

    with pytest.raises(TimedOut):
        tools._run(work)
    # Its tag is gone with it: later calls of other tools aren't cancelled.
    assert Tools(spark).run_sql("SELECT 1 AS a")["rows"] == [[1]]


def test_config_layers(tmp_path):
    (tmp_path / "home" / "gridloom").mkdir(parents=True)
    (tmp_path / "home" / "gridloom" / "config.toml").write_text('s3_region = "a"\ns3_endpoint = "e"\n[providers]\nmine = "http://m"\n')
    (tmp_path / "gridloom.toml").write_text('s3_region = "b"\n')
    c = load(str(tmp_path / "home"), str(tmp_path), {"GRIDLOOM_S3_ACCESS_KEY_ID": "k"})
    assert (c.s3_region, c.s3_access_key_id, c.all_providers()["mine"]) == ("b", "k", "http://m")
    assert c.spark_settings()["spark.hadoop.fs.s3a.endpoint"] == "e"


def test_command_line(spark, grid, capsys):
    def run(*args):
        code = main(["--output", "json", *map(str, args)])
        return code, json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    uri = grid / "g.zarr"
    assert run("info", uri)[1]["metadata"]["data_type"] == "Float64"
    assert run("extract", uri, grid / "p.geojson", "--out", grid / "x.parquet")[1]["chunks"] == 4
    code, again = run("extract", uri, grid / "p.geojson", "--out", grid / "x.parquet")
    assert code == 1 and again["status"] == "error" and "exists" in again["message"]
    assert run("resample", grid / "e.parquet", grid / "r.parquet", "--freq", "year")[0] == 0
    assert "share" in run("plot", grid / "e.parquet", "hist")[1]["plot"]
    assert run("plot", grid / "e.parquet", "line")[0] == run("plot", grid / "e.parquet", "heatmap")[0] == 0
    got = run("export", "SELECT 0 AS t, 5.0D AS value", grid / "o.zarr")[1]
    assert got["shape"] == [1]
    assert run("sql", "SELECT 1 AS a")[1]["rows"] == [[1]]
    assert main(["info", str(grid / "none.zarr")]) == 1


def test_stream(spark, folder):
    from gridloom.streaming.resample import resample_stream

    df = spark.createDataFrame(TWELVE, "time long, lat double, lon double, value double")
    df.write.parquet(str(folder / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(folder / "in"))
    q = resample_stream(stream, "day", "sum").writeStream.format("memory").queryName("days").outputMode("complete").option("checkpointLocation", str(folder / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("days").agg(F.sum("value")).first()[0] == sum(r[3] for r in TWELVE)
    with pytest.raises(ValueError):
        resample_stream(stream, "month", "sum")
