"""The command line: see COMMANDS; each prints for a person, for an agent (a key=value a line), or as JSON."""

from __future__ import annotations

import argparse
import json
import os
import sys
from collections.abc import Iterator

from .config import load
from .operators.extract import extract, plan
from .operators.grids import extent
from .operators.ingest import ingest
from .operators.plots import draw_heatmap, draw_histogram, draw_line, heatmap, histogram, line
from .operators.resample import detect, resample, value_column
from .operators.search import collections, search
from .session import allow, session
from .sources.resolve import Group, list_sources
from .sources.tables import METADATA_SCHEMA, describe
from .sources.vector import read_features
from .sources.zarr_sink import exists, export_zarr, remove


COMMANDS = ("info", "extract", "resample", "plot", "export", "ingest", "search", "sql", "shell", "serve", "completions")
MODES = ("table", "agent", "json")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="gridloom", description="Chunked geospatial arrays as tables")
    top.add_argument("--output", choices=MODES, default="table")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, text: str):
        p = sub.add_parser(name, help=text)
        p.add_argument("--output", choices=MODES, default=argparse.SUPPRESS)
        return p

    p = command("info", "what is at an address")
    p.add_argument("uri")
    p.add_argument("--asset")
    p.add_argument("--pin", action="append", default=[])
    p = command("extract", "cells in polygons")
    p.add_argument("uri")
    p.add_argument("vector")
    p.add_argument("--out", default="extracted_data.parquet")
    p.add_argument("--asset")
    p.add_argument("-y", "--yes", action="store_true")
    p.add_argument("--pin", action="append", default=[])
    p = command("resample", "aggregate extracted cells in time")
    p.add_argument("input")
    p.add_argument("out")
    p.add_argument("--freq", default="month")
    p.add_argument("--agg", default="avg")
    p.add_argument("-y", "--yes", action="store_true")
    p = command("plot", "draw a table as text")
    p.add_argument("input")
    p.add_argument("kind", choices=["hist", "heatmap", "line"], nargs="?", help="asked for, with the other choices, if left out")
    p.add_argument("--value")
    p.add_argument("--group-by")
    p.add_argument("--pin", action="append", default=[])
    p = command("export", "a query's result to an array")
    p.add_argument("sql", help="over views named after the tables given by --table")
    p.add_argument("out")
    p.add_argument("--value", default="value")
    p.add_argument("--chunks")
    p.add_argument("--table", action="append", default=[], metavar="NAME=PATH")
    p.add_argument("-y", "--yes", action="store_true")
    p = command("ingest", "a vector or CSV file to an array")
    p.add_argument("input")
    p.add_argument("out")
    p.add_argument("--value")
    p.add_argument("--chunks")
    p.add_argument("-y", "--yes", action="store_true")
    p = command("search", "arrays in a STAC catalogue")
    p.add_argument("--api", default="earth-search", help="an address or a provider's name")
    p.add_argument("--collection")
    p.add_argument("--bbox")
    p.add_argument("--datetime")
    p = command("sql", "run a statement over arrays and tables")
    p.add_argument("sql")
    p.add_argument("--table", action="append", default=[], metavar="NAME=PATH")
    p = command("shell", "statements one after the other, each ended by a semicolon")
    p.add_argument("--table", action="append", default=[], metavar="NAME=PATH")
    command("serve", "an agent's tools over standard input and output")
    p = command("completions", "a script that completes commands in a shell")
    p.add_argument("shell", choices=["bash", "zsh", "fish"])
    return top


def pins(given: list[str]) -> str | None:
    return ",".join(given) or None


def value_pins(given: list[str]) -> dict[str, float]:
    return {k: float(v) for k, _, v in (p.partition("=") for p in given)}


def free(path: str, args) -> None:
    """Make sure that a path can be written: by --yes, or by asking a person."""
    if not exists(path):
        return
    if not args.yes:
        if args.output != "table" or not sys.stdin.isatty():
            raise FileExistsError(f"{path} exists; overwrite it by --yes")
        if input(f"{path} exists. Overwrite it? [y/N] ").strip().lower() != "y":
            raise FileExistsError(f"{path} exists")
    remove(path)


def views(spark, given: list[str]) -> None:
    for item in given:
        name, _, path = item.partition("=")
        spark.read.parquet(path).createOrReplaceTempView(name)


def flat(data: dict, before: str = "") -> list[str]:
    """A key=value for each leaf, the keys joined by dots."""
    out = []
    for k, v in data.items():
        out += flat(v, f"{before}{k}.") if isinstance(v, dict) else [f"{before}{k}={v if isinstance(v, str) else json.dumps(v)}"]
    return out


def show(args, human: str, data: dict) -> None:
    if args.output == "json":
        print(json.dumps({"status": "success", **data}))
    else:
        print("\n".join(flat(data)) if args.output == "agent" else human)


def completions(shell: str) -> str:
    words = " ".join(COMMANDS)
    if shell == "fish":
        return f"complete -c gridloom -f -n __fish_use_subcommand -a '{words}'"
    load = "autoload -U +X bashcompinit && bashcompinit\n" if shell == "zsh" else ""
    return f"{load}complete -W '{words}' -o default gridloom"


def ask(what: str, choices: list[str], default: str) -> str:
    """A choice by its number or name; the default for an empty answer."""
    print(f"{what}: " + ", ".join(f"{k} {c}" for k, c in enumerate(choices, 1)))
    said = input(f"[{default}] ").strip()
    if said.isdigit() and 1 <= int(said) <= len(choices):
        return choices[int(said) - 1]
    return said if said in choices else default


def choose_plot(args, df) -> None:
    """Fill in what a plot needs by asking a person."""
    if args.output != "table" or not sys.stdin.isatty():
        raise ValueError("say which plot: hist, heatmap or line")
    args.kind = ask("plot", ["hist", "heatmap", "line"], "hist")
    args.value = args.value or ask("value", df.columns, value_column(df))
    if args.kind == "hist" and not args.group_by:
        group = ask("group by", ["nothing", *df.columns], "nothing")
        args.group_by = None if group == "nothing" else group


def statements(lines) -> Iterator[str]:
    """Statements of lines: each ends with a line that ends with a semicolon."""
    held: list[str] = []
    for line in lines:
        if not held and line.strip().lower().rstrip(";") in ("exit", "quit"):
            return
        held.append(line)
        if line.rstrip().endswith(";"):
            yield "".join(held)
            held = []
    if "".join(held).strip():
        yield "".join(held)


def run_shell(args, spark, lines) -> None:
    from .tools import Tools

    tools = Tools(spark)
    for statement in statements(lines):
        try:
            got = tools.run_sql(statement)
            rows = ["\t".join(got["columns"]), *["\t".join(map(str, r)) for r in got["rows"]]] if "rows" in got else ["ok"]
            show(args, "\n".join(rows), got)
        except Exception as e:  # the next statement may do better
            print(json.dumps({"status": "error", "message": str(e)}) if args.output == "json" else f"error: {e}")


def run(args) -> None:
    if args.command == "completions":
        return print(completions(args.shell))
    config = load()
    if config.allow_path:
        allow(config.allow_path)
    if args.command == "search":
        api = config.all_providers().get(args.api, args.api)
        if not args.collection:
            found = collections(api)
            return show(args, "\n".join(f"{c['id']}: {c['title']}" for c in found), {"collections": found})
        found = search(api, args.collection, args.bbox, args.datetime)
        return show(args, "\n".join(f["uri"] for f in found), {"uris": [f["uri"] for f in found]})
    if args.command == "info":
        try:
            row = dict(zip(METADATA_SCHEMA.names, describe(args.uri, args.asset), strict=True))
        except Group as g:
            return show(args, "Arrays:\n" + "\n".join(f"  {a}" for a in g.arrays), {"arrays": g.arrays})
        if args.output == "agent":
            return show(args, "", row)
        return show(args, "\n".join(f"{k}: {v}" for k, v in row.items()), {"metadata": row, "arrays": list_sources(args.uri) if args.asset else []})

    spark = session(**config.spark_settings())
    if args.command == "extract":
        features = read_features(spark, args.vector)
        costs = plan(args.uri, extent(features), pins(args.pin), args.asset)
        if args.output == "table":
            print(f"{costs.chunks} chunks, {costs.megabytes:.1f} MB, about {costs.seconds:.1f} s over a network")
        free(args.out, args)
        extract(spark, args.uri, features, pins(args.pin), args.asset).write.parquet(args.out)
        show(args, f"wrote {args.out}", {"out": args.out, "chunks": costs.chunks})
    elif args.command == "resample":
        free(args.out, args)
        resample(spark.read.parquet(args.input), args.freq, args.agg).write.parquet(args.out)
        show(args, f"wrote {args.out}", {"out": args.out})
    elif args.command == "plot":
        df = spark.read.parquet(args.input)
        if args.kind is None:
            choose_plot(args, df)
        value = args.value or value_column(df)
        pinned = value_pins(args.pin)
        if args.kind == "hist":
            text = draw_histogram(histogram(df, value, args.group_by, pinned).collect(), bool(args.group_by))
        elif args.kind == "line":
            text = draw_line([r["mean"] for r in line(df, value, pins=pinned).collect()], value)
        else:
            c = detect(df)
            ends = df.selectExpr(f"min(`{c.lat}`)", f"max(`{c.lat}`)", f"min(`{c.lon}`)", f"max(`{c.lon}`)").first()
            text = draw_heatmap(heatmap(df, value, pinned).collect(), *ends, value)
        show(args, f"Plotting {args.kind} from {args.input} (Value: {value})\n{text}", {"plot": text})
    elif args.command == "export":
        views(spark, args.table)
        free(args.out, args)
        got = export_zarr(spark.sql(args.sql), args.out, args.value, chunks=args.chunks)
        show(args, f"wrote {args.out}: {got}", {"uri": args.out, **got})
    elif args.command == "ingest":
        free(args.out, args)
        got = ingest(spark, args.input, args.out, args.value, args.chunks)
        show(args, f"wrote {args.out}: {got}", {"uri": args.out, **got})
    elif args.command == "sql":
        from .tools import Tools

        views(spark, args.table)
        got = Tools(spark).run_sql(args.sql)
        rows = got.get("rows", [])
        show(args, "\n".join(["\t".join(got.get("columns", [])), *["\t".join(map(str, r)) for r in rows]]), got)
    elif args.command == "shell":
        views(spark, args.table)
        run_shell(args, spark, sys.stdin)
    elif args.command == "serve":
        from .tools import Tools, serve

        serve(sys.stdin, lambda s: print(s, flush=True), Tools(spark))


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        run(args)
    except Exception as e:  # any failure is a message, not a trace
        if args.output == "json":
            print(json.dumps({"status": "error", "message": str(e)}))
        elif args.output == "agent":
            print("\n".join(flat({"status": "error", "message": str(e)})))
        else:
            print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    os.environ.setdefault("PYTHONUNBUFFERED", "1")
    sys.exit(main())
