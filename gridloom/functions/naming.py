"""Names, grades, numbers as text, and configuration values."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from copy import deepcopy
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a feature's name tells of its method, in order.
METHODS = (("glcm", "glcm"), ("gabor", "gabor"), ("lbp", "lbp"), ("stat", "statistical"))
# Groups of features by words of their names, in order.
GROUPS = {
    "Spectral": ("band", "ndvi", "ndwi", "spectral", "reflectance"),
    "Topographic": ("elevation", "slope", "aspect", "curvature", "tpi"),
    "Texture": ("texture", "glcm", "contrast", "homogeneity"),
    "Derived": ("ratio", "index", "derived"),
}
# Grades by the least score.
GRADES = ((0.9, "excellent"), (0.8, "good"), (0.7, "fair"), (0.6, "poor"))
# Class names by application.
CLASS_LABELS = {
    "landslide_susceptibility": ("Very Low", "Low", "Moderate", "High", "Very High"),
    "mineral_targeting": ("Background", "Low Potential", "Moderate Potential", "High Potential"),
}


def first_of(cases: list[tuple[Column, str]], other: str) -> Column:
    out = F.lit(other)
    for condition, value in reversed(cases):
        out = F.when(condition, value).otherwise(out)
    return out


def clean_name(name: Column) -> Column:
    """Everything but letters, digits, underscores and hyphens becomes an underscore."""
    return F.regexp_replace(name, r"[^A-Za-z0-9_\-]", "_")


def method_of(feature: Column) -> Column:
    return first_of([(feature.contains(part), method) for part, method in METHODS], "unknown")


def group_of(feature: Column) -> Column:
    low = F.lower(feature)
    holds = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(low, w))
    return first_of([(holds(words), group) for group, words in GROUPS.items()], "Other")


def grade(score: Column) -> Column:
    return first_of([(score >= least, name) for least, name in GRADES], "very poor")


def number_text(value: Column) -> Column:
    """Three decimals between 0 and 1, else two; halves go to the even digit."""
    return F.when(value.between(0, 1), F.format_string("%.3f", F.bround(value, 3))).otherwise(F.format_string("%.2f", F.bround(value, 2)))


def percent_text(value: Column) -> Column:
    return F.format_string("%.1f%%", F.bround(value, 1))


def class_label(index: Column, application: str, classes: int = 2) -> Column:
    """The name of a class; numbered where the application has none of its own."""
    names = CLASS_LABELS.get(application) or tuple(f"Class_{k}" for k in range(classes))
    return first_of([(index == k, name) for k, name in enumerate(names)], "unknown")


def band_number(name: Column) -> Column:
    """The number of a band's name."""
    return F.try_to_number(F.nullif(F.regexp_extract(name, r"([0-9]+)", 1), F.lit("")), F.lit("999999")).cast("int")


def chosen_bands(columns: list[str], wanted: list[str | int]) -> list[str]:
    """Columns that a wanted text is part of, or whose number is wanted; each once, in the order asked for."""
    out: list[str] = []
    for want in wanted:
        for c in columns:
            digits = re.search(r"\d+", c)
            fits = want.lower() in c.lower() if isinstance(want, str) and not want.isdigit() else bool(digits) and int(digits[0]) == int(want)
            if fits and c not in out:
                out.append(c)
    return out


def with_environment(text: str, environment: dict[str, str]) -> str:
    """``${NAME}`` and ``${NAME:default}`` from the environment; unknown names without a default stay."""

    def value(m: re.Match) -> str:
        return environment.get(m[1], m[2] or m[0])

    return re.sub(r"\$\{([^}:]+)(?::([^}]*))?\}", value, text)


def merged(base: dict[str, Any], over: dict[str, Any]) -> dict[str, Any]:
    """Both, the second over the first, dict by dict."""
    out = deepcopy(base)
    for key, value in over.items():
        out[key] = merged(out[key], value) if isinstance(out.get(key), dict) and isinstance(value, dict) else deepcopy(value)
    return out


def get_dotted(config: dict[str, Any], path: str, default: Any = None) -> Any:
    here: Any = config
    for key in path.split("."):
        if not isinstance(here, dict) or key not in here:
            return default
        here = here[key]
    return here


def set_dotted(config: dict[str, Any], path: str, value: Any) -> dict[str, Any]:
    """A copy with the value at a path; what is missing on the way is made."""
    *parents, last = path.split(".")
    out = deepcopy(config)
    here = out
    for key in parents:
        if not isinstance(here.get(key), dict):
            here[key] = {}
        here = here[key]
    here[last] = value
    return out


def load_config(text: str, kind: str) -> dict[str, Any]:
    """JSON, TOML or (where its library is installed) YAML."""
    readers: dict[str, Callable[[str], Any]] = {"json": json.loads}
    if kind == "toml":
        import tomllib

        readers["toml"] = tomllib.loads
    elif kind in ("yaml", "yml"):
        import yaml

        readers[kind] = yaml.safe_load
    if kind not in readers:
        raise ValueError(f"no reader for {kind}")
    return readers[kind](text)
