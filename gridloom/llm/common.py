"""What the corpus operators share: table reads, texts through Arrow, and lineage cuts."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from gridloom.plans.lineage import cut, dropped, stored

__all__ = ["cut", "dropped", "map_texts", "pieces", "read", "release", "stored"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def map_texts(
    df: DataFrame,
    keys: list[str],
    text_col: str,
    fields: dict[str, pa.DataType],
    worker: Callable[[], Callable[[list], dict[str, list]]],
) -> DataFrame:
    """Keys as they are (nulls and types kept), beside columns made from each Arrow batch's texts.

    ``text_col`` is a column, or ``key.field`` for a field of a struct among the keys. A text that
    is in a key is sent to the workers once. ``worker()`` runs once per task and returns the
    function from some texts to their columns; it gets a batch in pieces of ``PIECE`` characters,
    as Python strings take several times their room in Arrow. No shuffle; a task holds one batch
    at a time.
    """
    key, _, part = text_col.partition(".")
    slim = df.select(*(F.col(k) for k in keys), *([] if key in keys else [F.col(text_col).alias("__text")]))
    at = keys.index(key) if key in keys else len(keys)
    part = part if key in keys else ""
    made = pa.schema(list(fields.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = worker()
        for batch in batches:
            texts = batch.column(at)
            texts = pc.struct_field(texts, part) if part else texts
            for start, end in pieces(texts):
                columns = kernel(texts.slice(start, end - start).to_pylist())
                arrays = [batch.column(i).slice(start, end - start) for i in range(len(keys))]
                arrays += [pa.array(columns[name], kind) for name, kind in fields.items()]
                yield pa.RecordBatch.from_arrays(arrays, [*keys, *fields])
        release()

    schema = slim.drop("__text").schema
    for field in from_arrow_schema(made):
        schema = schema.add(field)
    return slim.mapInArrow(run, schema)


def release() -> None:
    """Gives free memory back at the end of a task, Arrow's and that of the C library: a worker goes on to other tasks
    and stages, and what it held for one block would stay its own."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; other libraries give memory back themselves
    if trim:
        trim(0)


#: Bytes of text that are turned into Python strings at a time; a longer text goes alone.
PIECE = 1 << 21


def pieces(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows (from, to) whose texts have about PIECE bytes together."""
    start, size = 0, 0
    for k, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if size and size + n > PIECE:
            yield start, k
            start, size = k, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
