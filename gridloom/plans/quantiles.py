"""Exact quantiles by refined histograms.

One pass counts a column's values in ``BINS`` bins between its least and greatest value; the bin
that holds a rank is refined in the next pass, or fetched once it holds ``FEW`` values at most.
Each pass is an aggregate with partial sums, so no task ever holds a column's values; what comes
back to the driver are the bins and the few values of the last ones.

Bins are equal in width where a span's ends are of one size, equal in ratio where they are not,
and the three signs where zero is inside: so a span's relative width falls by ``BINS`` a pass
whatever the values are, and seven passes narrow any doubles down to one. NaN is missing;
infinite values are counted apart and keep their place in the order.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.plans.lineage import dropped, stored

#: Bins of a pass, values of a span that are fetched instead, the ratio of ends up to which widths are equal.
BINS, FEW, EVEN = 4096, 10_000, 64.0

#: Column, least and greatest value, values below, values within.
Span = tuple[int, float, float, int, int]


def bin_of(v: Column, low: float, high: float) -> Column:
    """The bin of a value between two ends; bins follow the order of values."""
    if low <= 0 <= high:
        return F.signum(v).cast("int") + 1
    small, large = sorted((abs(low), abs(high)))
    if large / EVEN > small:
        at = (F.log(F.abs(v)) - F.log(F.lit(abs(low)))) / (F.log(F.lit(abs(high))) - F.log(F.lit(abs(low))))
    else:
        at = (v - low) / (high - low)
    return F.greatest(F.least(F.floor(at * BINS), F.lit(BINS - 1)), F.lit(0)).cast("int")


def between(low: float, high: float, part: float) -> float:
    """The value a share of the way between two neighbours in order; an infinite one stays so."""
    if low == high or part == 0:
        return low
    if math.isinf(low) or math.isinf(high):
        return low + high
    return low + (high - low) * part if math.isfinite(high - low) else low * (1 - part) + high * part


def refined(data: DataFrame, spans: dict[Span, set[int]]) -> dict[Span, set[int]]:
    """The ranks by the bins of their spans."""
    listed = list(spans)

    def tagged(k: int, span: Span) -> Column:
        v = F.col(f"c{span[0]}")
        return F.when(v.between(span[1], span[2]), F.struct(F.lit(k).alias("k"), bin_of(v, span[1], span[2]).alias("bin"), v.alias("v")))

    each = F.filter(F.array(*[tagged(k, s) for k, s in enumerate(listed)]), lambda x: x.isNotNull())
    bins = data.select(F.explode(each).alias("x")).groupBy("x.k", "x.bin").agg(F.count("*").alias("n"), F.min("x.v").alias("lo"), F.max("x.v").alias("hi"))
    counts: dict[int, list] = {}
    for r in sorted(bins.collect(), key=lambda r: (r["k"], r["bin"])):
        counts.setdefault(r["k"], []).append(r)
    out: dict[Span, set[int]] = {}
    for k, span in enumerate(listed):
        for rank in spans[span]:
            before = span[3]
            for r in counts[k]:
                if rank < before + r["n"]:
                    out.setdefault((span[0], r["lo"], r["hi"], before, r["n"]), set()).add(rank)
                    break
                before += r["n"]
    return out


def fetched(data: DataFrame, spans: list[Span]) -> dict[Span, list[float]]:
    """The values of small spans, in order."""
    tagged = lambda k, s: F.when(F.col(f"c{s[0]}").between(s[1], s[2]), F.struct(F.lit(k).alias("k"), F.col(f"c{s[0]}").alias("v")))
    wanted = reduce(lambda a, b: a | b, [F.col(f"c{s[0]}").between(s[1], s[2]) for s in spans])
    each = F.filter(F.array(*[tagged(k, s) for k, s in enumerate(spans)]), lambda x: x.isNotNull())
    held: dict[int, list[float]] = {}
    for r in data.filter(wanted).select(F.explode(each).alias("x")).select("x.k", "x.v").collect():
        held.setdefault(r["k"], []).append(r["v"])
    return {s: sorted(held[k]) for k, s in enumerate(spans)}


def exact_quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> dict[str, float | None]:
    """By name, the quantile (column, share), interpolated between the two ranks beside it; None without values."""
    columns = sorted({c for c, _ in wanted.values()})
    data = stored(df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, c in enumerate(columns)]))
    infinite = F.lit(float("inf"))

    def facts(i: int) -> list[Column]:
        v = F.col(f"c{i}")
        finite = F.when(F.abs(v) < infinite, v)
        parts = (F.count_if(v == -infinite), F.count(finite), F.count_if(v == infinite), F.min(finite), F.max(finite))
        return [p.alias(f"{n}{i}") for p, n in zip(parts, ("under", "n", "over", "lo", "hi"))]

    whole = data.agg(*[f for i in range(len(columns)) for f in facts(i)]).first()
    found: dict[tuple[int, int], float] = {}
    spans: dict[Span, set[int]] = {}
    places: dict[str, tuple[int, int, int, float]] = {}
    for name, (column, share) in wanted.items():
        i = columns.index(column)
        under, n, over, low, high = (whole[f"{x}{i}"] for x in ("under", "n", "over", "lo", "hi"))
        total = under + n + over
        if not total:
            continue
        at = share * (total - 1)
        first = math.floor(at)
        places[name] = (i, first, min(first + 1, total - 1), at - first)
        for rank in places[name][1:3]:
            if under <= rank < under + n:
                spans.setdefault((i, low, high, under, n), set()).add(rank)
            else:
                found[(i, rank)] = -math.inf if rank < under else math.inf
    while spans:
        for s in [s for s in spans if s[1] == s[2]]:
            found |= {(s[0], rank): s[1] for rank in spans.pop(s)}
        small = [s for s in spans if s[4] <= FEW]
        for s, values in (fetched(data, small) if small else {}).items():
            found |= {(s[0], rank): values[rank - s[3]] for rank in spans.pop(s)}
        spans = refined(data, spans) if spans else {}
    dropped(data)
    out: dict[str, float | None] = dict.fromkeys(wanted)
    for name, (i, low, high, part) in places.items():
        out[name] = between(found[(i, low)], found[(i, high)], part)
    return out
