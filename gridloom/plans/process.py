"""Declared pipelines: a JSON process of steps becomes one lazy plan of DataFrames.

A step names its operator, hyperparameters, inputs and dependencies. An input is a step's id, or
an object with the ``source`` or the list of ``sources`` that feed it. ``{name}`` in any
string takes a variable; a string that is nothing else keeps the variable's type. Steps run
in dependency order; a cycle, a missing dependency or an unknown operator is an error. A
failing step is recorded, steps that depend on it are skipped, and the others go on.
"""

from __future__ import annotations

import ast
import graphlib
import json
import re
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession

Operator = Callable[..., DataFrame]


class Registry:
    """Operators by type, with aliases and categories."""

    def __init__(self) -> None:
        self.operators: dict[str, tuple[Operator, str]] = {}
        self.aliases: dict[str, str] = {}

    def register(self, kind: str, category: str = "other", aliases: tuple[str, ...] = (), override: bool = False) -> Callable[[Operator], Operator]:
        def add(f: Operator) -> Operator:
            if kind in self.operators and not override:
                raise ValueError(f"{kind} is registered already")
            self.operators[kind] = (f, category)
            self.aliases.update(dict.fromkeys(aliases, kind))
            return f

        return add

    def get(self, kind: str) -> Operator:
        kind = self.aliases.get(kind, kind)
        if kind not in self.operators:
            raise KeyError(f"no operator of type {kind}")
        return self.operators[kind][0]

    def find(self, pattern: str = "", category: str | None = None) -> list[str]:
        return sorted(k for k, (_, c) in self.operators.items() if re.search(pattern, k) and category in (None, c))


registry = Registry()


@dataclass(frozen=True)
class Step:
    id: str
    type: str
    hyperparameters: dict[str, Any] = field(default_factory=dict)
    inputs: dict[str, str | list[str]] = field(default_factory=dict)
    dependencies: tuple[str, ...] = ()
    condition: str | None = None

    def needs(self) -> set[str]:
        """Ids of all steps that come before this one."""
        fed = (x if isinstance(x, list) else [x] for x in self.inputs.values())
        return {*self.dependencies, *(i for ids in fed for i in ids)}


@dataclass
class Process:
    name: str
    steps: list[Step]

    def order(self) -> list[Step]:
        by_id = {s.id: s for s in self.steps}
        needs = {s.id: sorted(s.needs()) for s in self.steps}
        if unknown := sorted({d for ds in needs.values() for d in ds} - by_id.keys()):
            raise ValueError(f"unknown dependencies: {', '.join(unknown)}")
        sorter = graphlib.TopologicalSorter(needs)
        sorter.prepare()
        out: list[Step] = []
        while sorter.is_active():  # by id within a level, so the order is always the same
            level = sorted(sorter.get_ready())
            out += [by_id[k] for k in level]
            sorter.done(*level)
        return out


def substitute(value: Any, variables: dict[str, Any]) -> Any:
    if isinstance(value, dict):
        return {k: substitute(v, variables) for k, v in value.items()}
    if isinstance(value, list):
        return [substitute(v, variables) for v in value]
    if not isinstance(value, str):
        return value
    if (whole := re.fullmatch(r"\{(\w+)\}", value)) and whole[1] in variables:
        return variables[whole[1]]
    return re.sub(r"\{(\w+)\}", lambda m: str(variables.get(m[1], m[0])), value)


def template_names(value: Any) -> set[str]:
    return set(re.findall(r"\{(\w+)\}", json.dumps(value)))


# Variables that hold unless they are given.
DEFAULTS = {
    "local_data_path": "./data/inputs", "output_dir": "./data/outputs", "temp_dir": "./data/temp", "cache_dir": "./data/cache", "logs_dir": "./logs",
    "derivative": "elevation", "dem_derivative": "elevation", "slope_derivative": "slope", "aspect_derivative": "aspect", "curvature_derivative": "curvature",
    "file_extension": ".tif", "vector_extension": ".shp", "table_extension": ".csv",
    "resolution": 10, "buffer_distance": 1000, "tile_size": 512, "overlap": 64,
    "n_estimators": 100, "max_depth": 10, "test_size": 0.3, "random_state": 42,
    "start_date": "2023-01-01", "end_date": "2023-12-31", "time_window": "1Y",
    "bbox": [0, 0, 1, 1], "crs": "EPSG:4326", "area_name": "default_area",
    "cloud_cover_threshold": 20, "quality_threshold": 0.8, "validation_split": 0.2,
    "colormap": "viridis", "dpi": 300, "figure_size": [10, 8],
    "log_level": "INFO", "enable_monitoring": True, "progress_interval": 10,
}


def derived(variables: dict[str, Any], now: datetime | None = None, defaults: bool = False) -> dict[str, Any]:
    """The variables (over the defaults, if asked), and what follows from the time, the area, the bounding box and the dates."""
    now = now or datetime.now(UTC)
    out = (DEFAULTS if defaults else {}) | variables
    more: dict[str, Any] = {"timestamp": now.strftime("%Y%m%d_%H%M%S"), "date": now.strftime("%Y-%m-%d"), "year": now.year, "month": now.month, "day": now.day}
    if "area_name" in out and "output_dir" in out:
        area = out["area_name"]
        folders = {"area_output_dir": out["output_dir"], "area_temp_dir": out.get("temp_dir", "./temp"), "area_cache_dir": out.get("cache_dir", "./cache")}
        more |= {name: f"{str(folder).rstrip('/')}/{area}" for name, folder in folders.items()}
    if isinstance(out.get("bbox"), list | tuple) and len(out["bbox"]) >= 4:
        west, south, east, north = out["bbox"][:4]
        more |= {"bbox_str": f"{west}_{south}_{east}_{north}", "bbox_width": abs(east - west), "bbox_height": abs(north - south)}
    if out.get("start_date") and out.get("end_date"):
        start, end = str(out["start_date"]), str(out["end_date"])
        more |= {"date_range": f"{start}_to_{end}", "start_year": start.split("-")[0], "end_year": end.split("-")[0]}
    return more | out


def variable_summary(value: Any) -> dict[str, int]:
    """How often each variable stands in a template."""
    counts: dict[str, int] = {}
    for name in re.findall(r"\{(\w+)\}", json.dumps(value)):
        counts[name] = counts.get(name, 0) + 1
    return dict(sorted(counts.items()))


def fed_by(given: Any) -> str | list[str]:
    """The step, or steps, behind an input."""
    if isinstance(given, dict):
        return list(given["sources"]) if "sources" in given else given["source"]
    return given


def load(definition: str | dict, variables: dict[str, Any] | None = None, defaults: bool = False) -> Process:
    """From JSON text or a dict; unique step ids, types and a name are required."""
    raw = json.loads(definition) if isinstance(definition, str) else definition
    given = (raw.get("global_config") or {}).get("default_values") or {}
    raw = substitute(raw, derived(given | (variables or {}), defaults=defaults))
    name = raw.get("process_info", {}).get("name")
    if not name:
        raise ValueError("process_info.name is missing")
    steps = []
    for s in raw.get("steps") or ():
        if not s.get("id") or not s.get("type"):
            raise ValueError("a step needs an id and a type")
        steps.append(Step(s["id"], s["type"], s.get("hyperparameters") or {}, {k: fed_by(v) for k, v in (s.get("inputs") or {}).items()}, tuple(s.get("dependencies") or ()), s.get("condition")))
    if not steps:
        raise ValueError("a process needs steps")
    if len({s.id for s in steps}) < len(steps):
        raise ValueError("step ids must be unique")
    return Process(name, steps)


class UnknownName(ValueError):
    """A condition asks for a variable that isn't there."""


def holds(condition: str, variables: dict[str, Any]) -> bool:
    """A condition of literals, variables, comparisons and boolean operators."""
    compare = {
        ast.Eq: lambda a, b: a == b, ast.NotEq: lambda a, b: a != b, ast.Lt: lambda a, b: a < b, ast.LtE: lambda a, b: a <= b,
        ast.Gt: lambda a, b: a > b, ast.GtE: lambda a, b: a >= b, ast.In: lambda a, b: a in b, ast.NotIn: lambda a, b: a not in b,
    }

    def value(n: ast.AST) -> Any:
        match n:
            case ast.Expression():
                return value(n.body)
            case ast.Constant():
                return n.value
            case ast.Name() if n.id in variables:
                return variables[n.id]
            case ast.Name() if n.id in ("true", "false", "null"):
                return json.loads(n.id)
            case ast.Name() | ast.Set():  # a set is a template that nothing filled
                raise UnknownName(ast.unparse(n))
            case ast.List() | ast.Tuple():
                return [value(x) for x in n.elts]
            case ast.UnaryOp(op=ast.Not()):
                return not value(n.operand)
            case ast.BoolOp():
                return (all if isinstance(n.op, ast.And) else any)(value(x) for x in n.values)
            case ast.Compare():
                sides = [value(x) for x in (n.left, *n.comparators)]
                return all(compare[type(op)](a, b) for op, a, b in zip(n.ops, sides, sides[1:]))
        raise ValueError(f"not allowed in a condition: {ast.unparse(n)}")

    return bool(value(ast.parse(condition, mode="eval")))


@dataclass
class Context:
    """Variables, lazy results by step, and what happened to each step."""

    spark: SparkSession
    variables: dict[str, Any]
    results: dict[str, DataFrame] = field(default_factory=dict)
    history: list[dict[str, Any]] = field(default_factory=list)

    def summary(self) -> dict[str, Any]:
        counts: dict[str, int] = {}
        for h in self.history:
            counts[h["status"]] = counts.get(h["status"], 0) + 1
        done, failed = counts.get("success", 0), counts.get("failed", 0)
        status = "success" if not failed else "completed_with_errors" if done else "failed"
        return {"status": status, "steps": len(self.history), **counts}

    def report(self) -> DataFrame:
        rows = [(h["step_id"], h["type"], h["status"], h.get("error"), h["seconds"]) for h in self.history]
        return self.spark.createDataFrame(rows, "step_id string, step_type string, status string, error_message string, execution_time double")


def wanted(step: Step, variables: dict[str, Any]) -> bool:
    """Whether a step's condition holds; one that asks for an unknown variable doesn't keep the step from running."""
    try:
        return not step.condition or holds(step.condition, variables)
    except UnknownName:
        return True


def execute(process: Process, spark: SparkSession, variables: dict[str, Any] | None = None, known: Registry = registry, sink: Callable[[str, DataFrame], Any] | None = None) -> Context:
    """Builds each step's DataFrame. Nothing is computed before a sink asks for it: with ``sink(step id, frame)``, called
    for each step as it is built, a step that fails at run time is a failed step."""
    context = Context(spark, derived(variables or {}))
    bad: set[str] = set()
    for step in process.order():
        began, record = time.monotonic(), {"step_id": step.id, "type": step.type}
        try:
            if step.needs() & bad:
                record["status"] = "skipped"
                bad.add(step.id)
            elif not wanted(step, context.variables):
                record["status"] = "skipped"
                if any(step.id in s.needs() - set(s.dependencies) for s in process.steps):
                    bad.add(step.id)
            else:
                frames = {name: [context.results[i] for i in source] if isinstance(source, list) else context.results[source] for name, source in step.inputs.items()}
                made = known.get(step.type)(spark, **frames, **step.hyperparameters)
                if sink:
                    sink(step.id, made)
                context.results[step.id] = made
                record["status"] = "success"
        except Exception as e:  # noqa: BLE001 - a step's failure is the run's result
            record |= {"status": "failed", "error": str(e)[:500]}
            bad.add(step.id)
        context.history.append(record | {"seconds": time.monotonic() - began})
    return context
