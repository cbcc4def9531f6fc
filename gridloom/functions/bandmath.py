"""Band math: a whitelisted expression compiler and the index registry."""

from __future__ import annotations

import ast
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Index formulas over logical bands.
INDICES = {
    "NDVI": "(nir - red) / (nir + red)",
    "EVI": "2.5 * ((nir - red) / (nir + 6 * red - 7.5 * blue + 1))",
    "SAVI": "((nir - red) / (nir + red + 0.5)) * 1.5",
    "NDWI": "(green - nir) / (green + nir)",
    "MNDWI": "(green - swir1) / (green + swir1)",
    "NDBI": "(swir1 - nir) / (swir1 + nir)",
    "UI": "(swir1 - nir) / (swir1 + nir)",
    "BSI": "((swir1 + red) - (nir + blue)) / ((swir1 + red) + (nir + blue))",
    "clay_minerals": "swir1 / swir2",
    "alunite": "swir1 / swir2",
    "iron_oxides": "red / blue",
    "carbonates": "swir2 / swir1",
    "ferrous_iron": "swir2 / swir1",
    "ferric_iron": "red / green",
    "alteration_index": "(swir1 + swir2) / (nir + red)",
    "gossan_index": "red / nir",
}
# Ranges that indices may be clipped to.
RANGES = {"NDVI": (-1, 1), "NDWI": (-1, 1), "SAVI": (-1.5, 1.5), "EVI": (-1, 1), "BSI": (-1, 1)}
# Physical bands of the sensors.
SENSORS = {
    "sentinel2": {"blue": "b02", "green": "b03", "red": "b04", "nir": "b08", "swir1": "b11", "swir2": "b12"},
    "landsat8": {"blue": "b2", "green": "b3", "red": "b4", "nir": "b5", "swir1": "b6", "swir2": "b7"},
    "generic": {"blue": "band_1", "green": "band_2", "red": "band_3", "nir": "band_4", "swir1": "band_5", "swir2": "band_6"},
}

FUNCTIONS: dict[str, Callable[..., Column]] = {
    "sqrt": lambda x: F.when(x >= 0, F.sqrt(x)), "abs": F.abs, "exp": F.exp, "sin": F.sin, "cos": F.cos, "tan": F.tan,
    "log": lambda x: F.when(x > 0, F.ln(x)), "log10": lambda x: F.when(x > 0, F.log10(x)),
    "arcsin": lambda x: F.when(F.abs(x) <= 1, F.asin(x)), "arccos": lambda x: F.when(F.abs(x) <= 1, F.acos(x)), "arctan": F.atan,
    "min": F.least, "max": F.greatest, "where": lambda c, a, b: F.when(c, a).otherwise(b),
    "clip": lambda x, lo, hi: F.greatest(F.least(x, hi), lo),
}
BINARY = {
    ast.Add: lambda a, b: a + b, ast.Sub: lambda a, b: a - b, ast.Mult: lambda a, b: a * b,
    ast.Div: lambda a, b: F.try_divide(a, b), ast.Pow: lambda a, b: F.pow(a, b),
}
COMPARE = {
    ast.Lt: lambda a, b: a < b, ast.LtE: lambda a, b: a <= b, ast.Gt: lambda a, b: a > b,
    ast.GtE: lambda a, b: a >= b, ast.Eq: lambda a, b: a == b, ast.NotEq: lambda a, b: a != b,
}


def compile_expression(text: str, bands: dict[str, str]) -> Column:
    """A Column from a formula; only bands, numbers, arithmetic, comparisons and the listed functions.

    Division by zero and values outside a function's domain give NULL. A chain of
    comparisons holds where each of them holds.
    """

    def build(node: ast.AST) -> Column:
        match node:
            case ast.Expression():
                return build(node.body)
            case ast.Constant(value=bool()) | ast.Constant(value=int()) | ast.Constant(value=float()):
                return F.lit(node.value if isinstance(node.value, bool) else float(node.value))
            case ast.Name() if node.id in bands:
                return F.col(bands[node.id])
            case ast.UnaryOp(op=ast.USub()):
                return -build(node.operand)
            case ast.UnaryOp(op=ast.UAdd()):
                return build(node.operand)
            case ast.BinOp() if type(node.op) in BINARY:
                return BINARY[type(node.op)](build(node.left), build(node.right))
            case ast.Compare() if all(type(op) in COMPARE for op in node.ops):
                sides = [build(x) for x in (node.left, *node.comparators)]
                checks = [COMPARE[type(op)](a, b) for op, a, b in zip(node.ops, sides, sides[1:])]
                out = checks[0]
                for check in checks[1:]:
                    out = out & check
                return out
            case ast.Call(func=ast.Name()) if node.func.id in FUNCTIONS and not node.keywords:
                return FUNCTIONS[node.func.id](*map(build, node.args))
        raise ValueError(f"not allowed in an expression: {ast.unparse(node)}")

    return build(ast.parse(text, mode="eval"))


def finite(value: Column) -> Column:
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def spectral_index(name: str, sensor: str = "sentinel2", clip: bool = False) -> Column:
    value = finite(compile_expression(INDICES[name], SENSORS[sensor]))
    if clip and name in RANGES:
        low, high = RANGES[name]
        value = F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(float(high))), F.lit(float(low))))
    return value


def band_math(df: DataFrame, operations: dict[str, str], mask: str | None = None, clip: tuple[float, float] | None = None, scale: float = 1.0, offset: float = 0.0) -> DataFrame:
    """Adds a column per formula: evaluate, mask, drop non-finite values, clip, scale."""
    bands = {c: c for c in df.columns}
    out = {}
    for name, text in operations.items():
        value = finite(compile_expression(text, bands))
        if mask:
            value = F.when(compile_expression(mask, bands), value)
        if clip:
            value = F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(clip[1])), F.lit(clip[0])))
        out[name] = value * scale + offset
    return df.withColumns(out)
