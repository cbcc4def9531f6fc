"""Mixing sources to target weights by Pareto order sampling.

A source's target is its share by weight of all words, stopped at ``most`` times its own
words; what is cut off goes to the others by weight until none is above. Each of its
documents then has a number of copies to expect of its own: the source's ``target / words``,
tilted by the logarithm of the document's length (``TILT``), so that a source's words come
from more of its shorter documents; it is between 0 and ``most``, and over the source the
expected words are the target. The whole part are certain copies. The fraction p is the
inclusion probability of one more, by Pareto sampling: documents are ranked by random odds
``u / (1 - u)`` from a hash over inclusion odds ``p / (1 - p)``, and the sample is the prefix
of that order that fills the words still missing. Where the next document would overfill, the
order goes on with those behind it that still fit, until none does, so the sample's size in
words is fixed up to less than the smallest document left.

DataFrame functions only. A source's prefix is found without gathering the source: words are
summed per source and slice of the rank order (a partial aggregate; the slices grow with the
root of a source's rows), the running sum over slices names the slice where the prefix ends,
and only its documents are ordered: what is taken first is all up to one place for each source.
Behind it the next ``HEAD`` documents that fit are looked at together, pass by pass; the words
missing are then fewer than one document's, so few are taken and passes are few.
The tables per source are broadcast up to ``BROADCAST`` sources; beyond, a source's rows are
dealt over ``SALTS`` parts, each with a copy of the source's row.

Defined results: null text counts as empty; an empty text takes no words, has the certain
copies of its source's ratio and no sampled one; null is a source of its own and comes last; repeated rows are sampled as one after another, and as they are alike
the result is the same in any order; reruns agree; an empty table stays empty; other
columns are ignored whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import cut

#: The least slices of a source's rank order, and how far a document's expected copies may lean on its length (0 to 1).
SLICES, TILT = 64, 0.5
#: Documents of a source that are looked at in one pass behind its prefix.
HEAD = 512
#: Sources whose tables are broadcast at most; parts of a source's rows where they meet its row beyond that.
BROADCAST, SALTS = 20_000, 64
#: Behind every place of the order.
END = (2**31 - 1, float("inf"), 2**63 - 1, 2**63 - 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[float], most: float) -> DataFrame:
    """Per source: ``source_size``, ``weight`` by rank (null last, weights repeating) and ``target``.

    The level at which a source's target stops growing is ``most * size / weight``. In
    rising order of it, a source stops exactly if the words left, shared by the weights
    left, reach its stop; both are running sums over the rows of sources.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    listed = F.array(*[F.lit(float(w)) for w in weights])
    ranked = per.withColumn("weight", F.element_at(listed, (F.row_number().over(ordered) - 1) % len(weights) + 1))
    rising = Window.orderBy((F.col("source_size") / F.col("weight")), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    after = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0.0))
    level = left / F.sum("weight").over(after)
    leveled = ranked.withColumn("level", level).withColumn("stop", F.col("source_size") * F.lit(float(most)))
    # The first source that doesn't stop fixes the level for itself and all behind it.
    free = F.col("level") * F.col("weight") < F.col("stop")
    final = F.min(F.when(free, F.struct((F.col("source_size") / F.col("weight")).alias("k"), "level"))).over(Window.partitionBy())
    return leveled.select(
        "source",
        "source_size",
        "weight",
        F.when(final.isNull(), F.col("stop")).otherwise(F.least("stop", final["level"] * F.col("weight"))).alias("target"),
    )


def beside_source(rows: DataFrame, per_source: DataFrame, sources: int) -> DataFrame:
    """Rows with their source's columns."""
    table = per_source.withColumnRenamed("source", "of")
    same = F.col("source").eqNullSafe(F.col("of"))
    if sources <= BROADCAST:
        return rows.join(F.broadcast(table), same).drop("of")
    copies = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(SALTS)))
    return dealt.join(copies, same & (F.col("part") == F.col("salt"))).drop("part", "salt", "of")


def place(slice_: Column | int, key: Column | float, tie: Column | int, row: Column | int) -> Column:
    """A place in the rank order; places compare as structs."""
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(as_column(slice_).cast("int").alias("slice"), as_column(key).cast("double").alias("key"), as_column(tie).cast("long").alias("tie"), as_column(row).cast("long").alias("row"))


def prefix(rows: DataFrame) -> DataFrame:
    """Of rows (source, size, place, room), per source the last place of the prefix of at most ``room`` words, and
    its words ``got``."""
    slices = rows.groupBy("source", F.col("place.slice").alias("slice")).agg(F.sum("size").alias("words"), F.first("room").alias("room"))
    order = Window.partitionBy("source").orderBy("slice")
    upto = slices.withColumn("upto", F.sum("words").over(order))
    over = upto.filter(F.col("upto") > F.col("room")).groupBy("source").agg(F.min("slice").alias("cut"), F.min(F.col("upto") - F.col("words")).alias("base"))
    every = slices.groupBy("source").agg(F.sum("words").alias("all"))
    ends = cut(every.join(over.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left").drop("of"))
    split = rows.join(over.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")) & (F.col("place.slice") == F.col("cut")))
    inside = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = split.withColumn("sum", F.col("base") + F.sum("size").over(inside)).filter(F.col("sum") <= F.col("room"))
    last = sums.groupBy(F.col("source").alias("of")).agg(F.max("place").alias("last"), F.max("sum").alias("sum"))
    before = place(F.col("cut") - 1, *END[1:])
    return ends.join(last, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "source",
        F.when(F.col("cut").isNull(), place(*END)).otherwise(F.coalesce("last", before)).alias("upto"),
        F.when(F.col("cut").isNull(), F.col("all")).otherwise(F.coalesce("sum", "base")).alias("got"),
    )


def next_ones(rows: DataFrame) -> DataFrame:
    """Of rows (source, size, row, place, room), per source the rows that fit among the next HEAD of the order, taken one
    after another, as ``rows``, the words that are ``left`` then, and the ``last`` place that was looked at."""
    ahead = Window.partitionBy("source").orderBy("place")
    head = rows.withColumn("k", F.row_number().over(ahead)).filter(F.col("k") <= HEAD)
    listed = head.groupBy("source").agg(F.first("room").alias("room"), F.sort_array(F.collect_list(F.struct("place", "size"))).alias("docs"))
    nothing = F.struct(F.col("room").alias("left"), F.array().cast("array<bigint>").alias("rows"))

    def take(so_far: Column, doc: Column) -> Column:
        taken = F.struct((so_far["left"] - doc["size"]).alias("left"), F.array_append(so_far["rows"], doc["place"]["row"]).alias("rows"))
        return F.when(doc["size"] <= so_far["left"], taken).otherwise(so_far)

    folded = listed.select("source", F.aggregate("docs", nothing, take).alias("f"), F.element_at("docs", -1)["place"].alias("last"))
    return folded.select("source", "f.left", "f.rows", "last")


def expected_copies(ratio: Column, most: float, lean: Column) -> Column:
    """Copies to expect of a document that leans to fewer or more by -1 to 1; leans weighted by sizes sum to 0."""
    return whole(ratio + TILT * F.least(ratio, most - ratio) * lean)


def whole(x: Column) -> Column:
    """What is a rounding error off a whole number as that number."""
    return F.when(F.abs(x - F.round(x)) < 1e-9, F.round(x)).otherwise(x)


def mix_sources(
    docs: DataFrame,
    weights: list[float],
    most: float = 3.0,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep: tuple[str, ...] | list[str] = (),
) -> DataFrame:
    """Per row: the id, the columns ``keep``, ``source``, ``size``, ``source_size``, ``target`` and ``copies`` (0 or more)."""
    uniform = F.abs(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)) % F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))
    sizes = cut(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            uniform.alias("u"),
            F.xxhash64(F.col(text_col), F.lit(seed)).alias("tie"),
            F.monotonically_increasing_id().alias("row"),
            F.struct(*[F.col(c) for c in keep] or [F.lit(0)]).alias("kept"),
        )
    )
    # To six places, so that the order of the sums tells nothing.
    full = sizes.filter("size > 0")
    logs = full.groupBy("source").agg(
        F.count("*").alias("rows"),
        F.round(F.sum(F.col("size") * F.log("size")) / F.sum("size"), 6).alias("middle"),
        F.log(F.min("size")).alias("least"),
        F.log(F.max("size")).alias("greatest"),
    )
    targets = cut(
        source_targets(sizes, weights, most)
        .join(logs.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left")
        .withColumn("ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("reach", F.greatest(F.col("middle") - F.col("least"), F.col("greatest") - F.col("middle")))
        .withColumn("slices", F.greatest(F.lit(float(SLICES)), F.ceil(F.sqrt("rows"))))
        .drop("of", "least", "greatest", "rows", "weight")
    )
    sources = targets.count()
    lean = F.when(F.col("reach") > 1e-5, (F.col("middle") - F.log("size")) / F.col("reach")).otherwise(0.0)
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    ranked = cut(
        beside_source(sizes, targets, sources)
        .withColumn("expected", F.when(F.col("size") > 0, expected_copies(F.col("ratio"), most, lean)).otherwise(whole(F.col("ratio"))))
        .withColumn("certain", F.floor(F.greatest("expected", F.lit(0.0))))
        .withColumn("p", F.col("expected") - F.col("certain"))
        .withColumn("key", F.when((F.col("p") > 1e-9) & (F.col("size") > 0), odds))
        .withColumn("place", F.when(F.col("key").isNotNull(), place(F.floor(F.col("key") / (1 + F.col("key")) * F.col("slices")), F.col("key"), F.col("tie"), F.col("row"))))
        .select("id", "source", "size", "row", "kept", "source_size", "target", "certain", "place")
    )
    sure = ranked.groupBy("source").agg(F.first("target").alias("target"), F.sum(F.col("certain") * F.col("size")).alias("sure"))
    # Per source: the words still missing, how far the order is read, and where its prefix ends.
    state = sure.select("source", (F.col("target") - F.col("sure")).alias("room"), place(-1, 0.0, 0, 0).alias("read"))
    rest = ranked.filter(F.col("place").isNotNull()).select("source", "size", "row", "place")
    first = prefix(beside_source(rest, state, sources).filter(F.col("size") <= F.col("room"))).withColumnRenamed("source", "of")
    state = cut(
        state.join(first, F.col("source").eqNullSafe(F.col("of")), "left")
        .select("source", (F.col("room") - F.coalesce("got", F.lit(0))).alias("room"), F.coalesce("upto", "read").alias("read"), "upto", F.col("room").alias("most"))
    )
    ends = state.select("source", "upto", "most")
    state = state.select("source", "room", "read")
    picked = None
    while True:
        fits = (F.col("size") <= F.col("room")) & (F.col("place") > F.col("read"))
        rest = cut(beside_source(rest, state, sources).filter(fits).drop("read"))
        if rest.isEmpty():
            break
        step = cut(next_ones(rest))
        more = step.select(F.explode("rows").alias("row"))
        picked = more if picked is None else picked.unionByName(more)
        state = cut(
            state.join(step.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left")
            .select("source", F.coalesce("left", "room").alias("room"), F.coalesce("last", "read").alias("read"))
        )
        rest = rest.drop("room")
    chosen = (F.col("size") <= F.col("most")) & (F.col("place") <= F.col("upto"))
    rows = beside_source(ranked, ends, sources).withColumn("extra", F.when(F.coalesce(chosen, F.lit(False)), 1).otherwise(0))
    if picked is not None:
        later = picked.withColumn("later", F.lit(1))
        rows = rows.join(later, "row", "left").withColumn("extra", F.col("extra") + F.coalesce("later", F.lit(0)))
    return rows.select(
        F.col("id").alias(id_col),
        *[F.col("kept")[c].alias(c) for c in keep],
        F.col("source").alias(source_col),
        "size",
        "source_size",
        "target",
        (F.col("certain") + F.col("extra")).cast("long").alias("copies"),
    )
