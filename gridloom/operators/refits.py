"""Logistic regressions over the folds of many label columns at a time: a label's own column and others dealt anew.

Rows are in the order of their folds, by hash. A dealt column gives the label of the k-th row by another hash to the k-th
row in that order, so it is made in buckets of that hash and cut along blocks of rows. A block is one row that holds its
values and all its label columns, a byte for each label of each row (more, if there are more labels than a byte tells
apart); folds follow from counts of the blocks before.

Fits are Newton's steps for all models together. A pass sums each model's loss, slopes and curvatures in each task, partial
sums meet in one aggregate, and only these sums come back, so passes don't grow with the models. A model whose fit has
ended takes no part in later passes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.validation import hash_number, ranked
from gridloom.plans.lineage import dropped, stored

#: Rows of a block, labels of a bucket while they are dealt, models that a task weighs at a time.
BLOCK, BUCKET, WIDE = 1024, 1 << 18, 512
#: Passes at most, as many as Spark's own fits take; a fit ends when a step would gain less than this share of a row's loss.
ROUNDS, STILL = 100, 1e-14

#: Of values, label columns and folds of a block's rows, sums for each model.
Kernel = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


class Refits(NamedTuple):
    """Blocks of rows with as many label columns, the row's own first; ``penalty`` of each coefficient, the last of which
    is the intercept's."""

    blocks: DataFrame
    rows: int
    columns: int
    labels: int
    folds: int
    penalty: np.ndarray

    @property
    def models(self) -> int:
        return self.columns * self.folds

    @property
    def outputs(self) -> int:
        """Two labels take one score, more take one each."""
        return 1 if self.labels <= 2 else self.labels


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """Another order of 64-bit numbers for each seed; distinct ones stay distinct."""
    z = x.astype("u8") + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def dealt_labels(rows: DataFrame, n: int, seeds: int, kind: np.dtype) -> DataFrame:
    """(seed, block, at, codes): a block's labels from the place ``at`` on, of n rows (base, code)."""
    buckets = -(-n // BUCKET)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, code = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(kind)
            made = []
            for seed in range(seeds):
                h = mixed(base, seed)
                order = np.argsort(h)
                h, y = h[order], code[order]
                bucket = ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype("i8")
                ends = np.flatnonzero(np.diff(bucket, append=-1)) + 1
                made += [(seed, int(bucket[a]), h[a:b].tobytes(), y[a:b].tobytes()) for a, b in zip([0, *ends[:-1]], ends)]
            if made:
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made), kinds)], ["seed", "bucket", "h", "codes"])

    def merge(pieces: pa.Table) -> pa.Table:
        h = np.frombuffer(b"".join(pieces.column("h").to_pylist()), "u8")
        y = np.frombuffer(b"".join(pieces.column("codes").to_pylist()), kind)[np.argsort(h, kind="stable")]
        first = pieces.select(["seed", "bucket"]).slice(0, 1)
        return first.append_column("n", pa.array([len(y)], pa.int64())).append_column("codes", pa.array([y.tobytes()], pa.binary()))

    pieces = rows.mapInArrow(deal, "seed int, bucket long, h binary, codes binary")
    ordered = stored(pieces.groupBy("seed", "bucket").applyInArrow(merge, "seed int, bucket long, n long, codes binary"))
    before = Window.partitionBy("seed").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = ordered.select("seed", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    start, end = F.col("start"), F.col("start") + F.col("n")
    spans = F.sequence(F.floor(start / BLOCK), F.floor((end - 1) / BLOCK))

    def part(block: F.Column) -> F.Column:
        low, high = F.greatest(start, block * BLOCK), F.least(end, (block + 1) * BLOCK)
        held = F.substring("codes", ((low - start) * kind.itemsize + 1).cast("int"), ((high - low) * kind.itemsize).cast("int"))
        return F.struct(block.alias("block"), (low - block * BLOCK).cast("int").alias("at"), held.alias("codes"))

    cut = stored(ordered.join(starts, ["seed", "bucket"]).select("seed", F.explode(F.transform(spans, part)).alias("p")).select("seed", "p.*"))
    dropped(ordered)
    return cut


def refits(df: DataFrame, columns: list[str], label: str, key: str, seeds: int, folds: int, c: float = 1.0) -> Refits | None:
    """Blocks of the complete rows with their label and as many dealt columns; None if there are none. Keys are distinct,
    labels are few."""
    values = F.array(*[F.col(x).cast("double") for x in columns]).alias("x")
    slim = df.select(*dict.fromkeys([*columns, label, key])).dropna()
    table = stored(slim.select(values, F.col(label).alias("y"), F.col(key).cast("string").alias("key")))
    names = sorted(r[0] for r in table.select("y").distinct().collect())
    if not names:
        dropped(table)
        return None
    each = [F.col("x")[k] for k in range(len(columns))]
    n, *moments = table.agg(F.count("*"), *[F.avg(x) for x in each], *[F.stddev_pop(x) for x in each]).first()
    mean, spread = np.array(moments, float).reshape(2, -1)
    if not np.isfinite([mean, spread]).all():
        dropped(table)
        raise ValueError("the columns of a regression must be finite")
    scale = np.where(spread > 0, spread, 1.0)
    kind = np.min_scalar_type(len(names) - 1)
    code = F.coalesce(*[F.when(F.col("y") == y, F.lit(k)) for k, y in enumerate(names)])

    def pack(key: tuple, rows: pa.Table, pieces: pa.Table) -> pa.Table:
        order = np.argsort(rows.column("__rank").to_numpy())
        x = np.asarray(rows.column("x").combine_chunks().flatten()).reshape(len(order), -1)[order]
        x = np.c_[(x - mean) / scale, np.ones(len(x))]
        y = np.zeros((seeds + 1, len(x)), kind)
        y[0] = rows.column("code").to_numpy()[order]
        for seed, at, held in zip(*(pieces.column(k).to_pylist() for k in ("seed", "at", "codes"))):
            part = np.frombuffer(held, kind)
            y[seed + 1, at : at + len(part)] = part
        counts = np.stack([(y == a).sum(1) for a in range(len(names))], 1)
        return pa.table({
            "block": pa.array([key[0].as_py()], pa.int64()), "x": pa.array([x.tobytes()], pa.binary()), "y": pa.array([y.tobytes()], pa.binary()),
            "counts": pa.array([counts.ravel().tolist()], pa.list_(pa.int64())),
        })

    coded = table.select("x", code.alias("code"), "key")
    dealt = dealt_labels(coded.select(hash_number(F.lit("dealt"), F.col("key")).cast("long").alias("base"), "code"), n, seeds, kind)
    placed = ranked(coded, hash_number(F.lit(42), F.col("key")), ["x", "code"]).withColumn("block", F.floor((F.col("__rank") - 1) / BLOCK))
    packed = stored(placed.groupBy("block").cogroup(dealt.groupBy("block")).applyInArrow(pack, "block long, x binary, y binary, counts array<long>"))
    before = Window.partitionBy("at").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = packed.select("block", F.posexplode("counts").alias("at", "n")).select("block", "at", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"))
    listed = counts.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("at", "n")))["n"].alias("before"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = stored(packed.drop("counts").join(listed, "block").repartition(parts, "block"))
    dropped(table, dealt, packed)
    return Refits(blocks, n, seeds + 1, len(names), folds, np.append(1 / (c * scale * scale), 0.0))


def summed(data: Refits, kernel: Kernel, models: int, width: int) -> np.ndarray:
    """The kernel's sums over all blocks, as many for each model."""
    columns, labels, folds, k = data.columns, data.labels, data.folds, len(data.penalty)
    kind = np.min_scalar_type(labels - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0)
        for batch in batches:
            for held_x, held_y, before in zip(*(batch.column(i) for i in range(3))):
                x = np.frombuffer(held_x.as_buffer(), "f8").reshape(-1, k)
                y = np.frombuffer(held_y.as_buffer(), kind).reshape(columns, -1)
                start, fold = np.asarray(before.values).reshape(columns, labels), np.zeros(y.shape, "i8")
                for a in range(labels):
                    own = y == a
                    fold = np.where(own, (np.cumsum(own, 1) - 1 + start[:, a : a + 1]) % folds, fold)
                found = kernel(x, y, fold).ravel()
                total = total + found if len(total) else found
        if len(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "sum"])

    parts = data.blocks.select("x", "y", "before").mapInArrow(run, "at long, sum double")
    found = parts.groupBy("at").agg(F.sum("sum").alias("sum")).toArrow()
    out = np.zeros(models * width)
    out[found.column("at").to_numpy()] = found.column("sum").to_numpy()
    return out.reshape(models, width)


def slopes(models: np.ndarray, w: np.ndarray, folds: int) -> Kernel:
    """Loss, slopes and curvatures on the training rows of models at coefficients (model, output, value)."""
    outputs = w.shape[1]
    i, j = np.triu_indices(w.shape[2])

    def kernel(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
        pairs, out = x[:, i] * x[:, j], []
        for s in range(0, len(models), WIDE):
            column, left_out = models[s : s + WIDE] // folds, models[s : s + WIDE] % folds
            own, train = y[column], fold[column] != left_out[:, None]
            z = [w[s : s + WIDE, g] @ x.T for g in range(outputs)]
            top = np.maximum(z[0], 0.0) if outputs == 1 else np.maximum.reduce(z)
            e = [np.exp(v - top) for v in z]
            total = sum(e, np.exp(-top) if outputs == 1 else 0.0)
            p = [v / total for v in e]
            hit = [own == (1 if outputs == 1 else g) for g in range(outputs)]
            loss = top + np.log(total) - sum(np.where(h, v, 0.0) for h, v in zip(hit, z))
            parts = [(loss * train).sum(1)[:, None]]
            parts += [((p[g] - hit[g]) * train) @ x for g in range(outputs)]
            parts += [(p[g] * ((g == h) - p[h]) * train) @ pairs for g in range(outputs) for h in range(g, outputs)]
            out.append(np.concatenate(parts, 1))
        return np.concatenate(out)

    return kernel


def hits(w: np.ndarray, folds: int) -> Kernel:
    """Test rows, and those that are told right, of all models."""
    outputs = w.shape[1]

    def kernel(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
        out = []
        for s in range(0, len(w), WIDE):
            models = np.arange(s, min(s + WIDE, len(w)))
            test = fold[models // folds] == (models % folds)[:, None]
            z = [w[models, g] @ x.T for g in range(outputs)]
            told = z[0] > 0 if outputs == 1 else np.argmax(z, 0)
            out.append(np.stack([test.sum(1), (test & (told == y[models // folds])).sum(1)], 1))
        return np.concatenate(out).astype(float)

    return kernel


def fitted(data: Refits) -> np.ndarray:
    """Coefficients (model, output, value) of least loss with the penalty; a step that doesn't lower the loss is halved."""
    outputs, k = data.outputs, len(data.penalty)
    i, j = np.triu_indices(k)
    penalty = np.tile(data.penalty, outputs)
    width = 1 + len(penalty) + outputs * (outputs + 1) // 2 * len(i)
    base, step = np.zeros((data.models, len(penalty))), np.zeros((data.models, len(penalty)))
    least, reach = np.full(data.models, np.inf), np.ones(data.models)
    active = np.arange(data.models)
    for _ in range(ROUNDS):
        w = base[active] - reach[active, None] * step[active]
        sums = summed(data, slopes(active, w.reshape(-1, outputs, k), data.folds), len(active), width)
        loss = sums[:, 0] + (penalty * w * w).sum(1) / 2
        grad = sums[:, 1 : 1 + len(penalty)] + penalty * w
        curve, blocks = np.zeros((len(active), outputs, k, outputs, k)), iter(np.split(sums[:, 1 + len(penalty) :], outputs * (outputs + 1) // 2, 1))
        for g in range(outputs):
            for h in range(g, outputs):
                found = next(blocks)
                for a, b in ((g, h), (h, g)):
                    curve[:, a, i, b, j] = curve[:, a, j, b, i] = found
        curve = curve.reshape(len(active), len(penalty), -1) + np.diag(penalty)
        lower = loss <= least[active] * (1 + 1e-10)
        newton = (np.linalg.pinv(curve, rcond=1e-12, hermitian=True) @ grad[:, :, None])[:, :, 0]
        gain = (newton * grad).sum(1)
        kept = active[lower]
        base[kept], step[kept], least[kept], reach[kept] = w[lower], newton[lower], loss[lower], 1.0
        reach[active[~lower]] /= 2
        active = active[np.where(lower, gain > STILL * data.rows, reach[active] > 1e-9)]
        if not len(active):
            break
    return base.reshape(-1, outputs, k)


def refit_scores(df: DataFrame, columns: list[str], label: str, key: str, permutations: int, folds: int) -> list[Fraction]:
    """Mean accuracies over the folds of models for the label and for each of its dealt columns; none without rows. They are
    fractions, as equal scores must be so to the last digit."""
    if folds < 2:
        raise ValueError("folds must be 2 or more")
    data = refits(df, columns, label, key, permutations, folds)
    if data is None:
        return []
    found = summed(data, hits(fitted(data), folds), data.models, 2).astype(int).reshape(-1, folds, 2)
    dropped(data.blocks)
    shares = [[Fraction(int(right), int(n)) for n, right in column if n] for column in found]
    return [sum(x, Fraction(0)) / len(x) for x in shares]
