"""Runs a declared process: ``python -m gridloom.cli process.json --bbox 85.3 27.6 85.4 27.7 --output-dir out``."""

from __future__ import annotations

import argparse
import json
import logging
import sys
from pathlib import Path
from typing import Any

from gridloom.functions.naming import load_config, merged, with_environment
from gridloom.plans.process import Process, execute, load, registry, variable_summary
from gridloom.plans.steps import register_steps

log = logging.getLogger("gridloom")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="gridloom", description=__doc__)
    p.add_argument("process", nargs="?", help="JSON file of the process")
    p.add_argument("--bbox", nargs=4, type=float, metavar=("WEST", "SOUTH", "EAST", "NORTH"))
    for name in ("start-date", "end-date", "area-name", "local-data-path", "output-dir", "temp-dir"):
        p.add_argument(f"--{name}")
    p.add_argument("--config", help="JSON, TOML or YAML file of more variables")
    p.add_argument("--var", action="append", default=[], metavar="NAME=JSON", help="one more variable")
    p.add_argument("--dry-run", action="store_true", help="show the order of the steps")
    p.add_argument("--validate", action="store_true", help="check the process only")
    p.add_argument("--info", action="store_true", help="show what the process is and which variables it uses")
    p.add_argument("--list-steps", action="store_true")
    p.add_argument("--list-processes", metavar="FOLDER")
    p.add_argument("--verbose", action="store_true")
    return p


def variables_of(args: argparse.Namespace, environment: dict[str, str]) -> dict[str, Any]:
    out: dict[str, Any] = {}
    if args.config:
        path = Path(args.config)
        out = load_config(with_environment(path.read_text(), environment), path.suffix.lstrip(".").lower())
    named = {k: getattr(args, k) for k in ("bbox", "start_date", "end_date", "area_name", "local_data_path", "output_dir", "temp_dir")}
    out = merged(out, {k: v for k, v in named.items() if v is not None})
    for pair in args.var:
        name, _, text = pair.partition("=")
        try:
            out[name] = json.loads(text)
        except json.JSONDecodeError:
            out[name] = text
    return out


def problems(process: Process) -> list[str]:
    """What keeps a process from running."""
    out = []
    try:
        process.order()
    except ValueError as e:
        out.append(str(e))
    for step in process.steps:
        try:
            registry.get(step.type)
        except KeyError as e:
            out.append(f"{step.id}: {e.args[0]}")
    return out


def main(argv: list[str] | None = None, environment: dict[str, str] | None = None) -> int:
    import os

    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if args.verbose else logging.INFO, format="%(asctime)s %(levelname)s %(message)s", stream=sys.stderr)
    register_steps()
    if args.list_steps:
        for kind, (_, category) in sorted(registry.operators.items()):
            print(f"{kind}\t{category}")
        return 0
    if args.list_processes:
        for path in sorted(Path(args.list_processes).glob("*.json")):
            print(path.name, json.loads(path.read_text()).get("process_info", {}).get("name", ""), sep="\t")
        return 0
    if not args.process:
        parser().error("a process file is needed")
    text = Path(args.process).read_text()
    variables = variables_of(args, dict(os.environ) if environment is None else environment)
    try:
        process = load(text, variables, defaults=True)
    except (ValueError, json.JSONDecodeError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    if args.info:
        print(json.dumps({"name": process.name, "steps": [s.id for s in process.steps], "variables": variable_summary(json.loads(text))}, indent=2))
        return 0
    wrong = problems(process)
    for line in wrong:
        print(f"error: {line}", file=sys.stderr)
    if args.validate or wrong:
        return 2 if wrong else 0
    if args.dry_run:
        for k, step in enumerate(process.order(), 1):
            print(f"{k}. {step.id} ({step.type})")
        return 0

    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName(f"gridloom {process.name}").getOrCreate()
    folder = variables.get("output_dir")

    def sink(step: str, frame: Any) -> None:
        log.info("step %s", step)
        if folder:
            frame.write.mode("overwrite").parquet(f"{folder}/{step}")
        else:
            frame.write.format("noop").mode("overwrite").save()

    context = execute(process, spark, variables, sink=sink)
    if folder:
        context.report().coalesce(1).write.mode("overwrite").json(f"{folder}/report")
    print(json.dumps(context.summary()))
    return 0 if context.summary()["status"] == "success" else 1


if __name__ == "__main__":
    sys.exit(main())
