"""Mixing sources to target weights by hash-random order and prefix sums.

Every document gets a hash-random key. Within each source the keys are cut into ranges;
the token sums of the ranges, added up in key order, tell in which range the source's
budget ends, and only that range is sorted document by document. So each source is cut
at its exact budget without sorting, or even shuffling, its documents, and no task holds
a source. Native DataFrame functions only.

A budget of more than the source takes it whole once or twice before the cut. Documents
of a source that are equal in key, id and size at the cut share what is left evenly.
Null texts have size 0, null sources are a source of their own that comes last, null ids
count as an empty id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trilayer.llm.names import set_aside
from trilayer.workspace import written

WORD = r"[^\x20\x09-\x0D]+"
SHARE = 1.5
MOST = 2
WEIGHTS = (5, 2, 1)
SEED = "mix-1:"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(id_column: str) -> Column:
    return F.md5(F.concat(F.lit(SEED), F.coalesce(F.col(id_column).cast("string"), F.lit(""))))


def targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """``sizes`` (mix_source, source_size, ...) with each source's target.

    ``share`` of all sizes is dealt by weight; a source is given at most ``most`` times
    its size, and the others get the excess by weight. Sources are taken in the order of
    (limit / weight); those before the first whose share stays within its limit are full.
    One row per source. These rows, and no others, pass through one task in sorted order, so
    sources may be sites (some millions of short rows), but not pages.
    """
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    by_name = Window.orderBy(F.col("mix_source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    known = (
        sizes.withColumn("place", place)
        .withColumn("weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")))
        .withColumn("limit", F.lit(most) * F.col("source_size"))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
    )
    by_ratio = Window.orderBy("ratio", "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (
        F.lit(float(share)) * F.sum("source_size").over(everything)
        - F.coalesce(F.sum("limit").over(before), F.lit(0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    open_level = F.when(F.col("level") <= F.col("ratio"), F.col("level"))
    return (
        known.withColumn("level", level)
        .withColumn("water", F.min(F.struct((F.col("level") > F.col("ratio")).alias("full"),
                                            F.col("ratio"), F.col("place"), open_level.alias("at")))
                    .over(everything)["at"])
        .withColumn("target", F.least(F.col("limit").cast("double"),
                                      F.col("water") * F.col("weight")))
        .drop("place", "weight", "limit", "ratio", "level", "water")
    )


def cuts(docs: DataFrame, id_column: str = "doc_id", source: str = "source", size: str = "size",
         **settings) -> DataFrame:
    """One row per source: its size and target, the whole passes taken, and where the
    last pass is cut: the key, id and size of the documents there and what each gives."""
    keyed = docs.select(
        F.col(source).alias("mix_source"),
        F.col(id_column).cast("string").alias("mix_id"),
        F.col(size).alias("mix_size"),
        random_key(id_column).alias("mix_key"),
    )
    sizes = keyed.groupBy("mix_source").agg(
        F.sum("mix_size").alias("source_size"), F.count("*").alias("documents")
    )
    plan = targets(sizes, **settings)
    budget = F.floor("target")
    plan = (
        plan.withColumn("mix_passes", F.when(F.col("source_size") > 0,
                                         F.floor(budget / F.col("source_size"))).otherwise(0))
        .withColumn("rest", budget - F.col("mix_passes") * F.col("source_size"))
        .withColumn("ranges", F.ceil(F.sqrt("documents")))
    )
    plan = written(plan, "mix-plan")
    fraction = F.conv(F.substring("mix_key", 1, 8), 16, 10).cast("long")
    ranged = keyed.alias("k").join(
        plan.select(F.col("mix_source").alias("plan_source"), "ranges", "rest").alias("p"),
        F.col("mix_source").eqNullSafe(F.col("plan_source")),
    ).withColumn("range", F.shiftright(fraction * F.col("ranges"), 32))
    sums = ranged.groupBy("mix_source", "range").agg(
        F.sum("mix_size").alias("range_size"), F.max("rest").alias("rest")
    )
    in_source = Window.partitionBy("mix_source").orderBy("range")
    cut_range = (
        sums.withColumn("upto", F.sum("range_size").over(in_source))
        .filter((F.col("upto") > F.col("rest"))
                & (F.col("upto") - F.col("range_size") <= F.col("rest")))
        .select(F.col("mix_source").alias("cut_source"), F.col("range").alias("cut_range"),
                (F.col("rest") - F.col("upto") + F.col("range_size")).alias("left"))
    )
    inside = ranged.join(
        cut_range,
        F.col("mix_source").eqNullSafe(F.col("cut_source")) & (F.col("range") == F.col("cut_range")),
    )
    equal = inside.groupBy("mix_source", "mix_key", "mix_id", "mix_size", "left").agg(
        F.count("*").alias("copies")
    )
    ordered = Window.partitionBy("mix_source").orderBy("mix_key", "mix_id", "mix_size")
    whole = F.col("copies") * F.col("mix_size")
    at = (
        equal.withColumn("sum", F.sum(whole).over(ordered))
        .filter((F.col("sum") > F.col("left")) & (F.col("sum") - whole <= F.col("left")))
        .select(F.col("mix_source").alias("at_source"), F.col("mix_key").alias("mix_cut_key"),
                F.col("mix_id").alias("mix_cut_id"), F.col("mix_size").alias("mix_cut_size"),
                F.floor((F.col("left") - F.col("sum") + whole) / F.col("copies"))
                .alias("mix_cut_gives"))
    )
    return plan.join(at, F.col("mix_source").eqNullSafe(F.col("at_source")), "left").drop(
        "at_source", "documents", "ranges", "rest"
    )


def mix(docs: DataFrame, id_column: str = "doc_id", source: str = "source",
        text: str = "text", size: str | None = None, **settings) -> DataFrame:
    """``docs`` with the columns size, source_size, target and taken (words the mix takes
    of the document, repeats counted); input columns of these names are replaced. Only one row per source
    joins the documents. Input columns whose names begin with ``mix_`` are returned as they
    are."""
    docs, aside = set_aside(docs.drop("source_size", "target", "taken"), "mix_")
    id_column, source, text, size = (aside.get(c, c) for c in (id_column, source, text, size))
    if size is None:
        sized = docs.withColumn("size", word_count(text))
        narrow = written(sized.select(F.col(id_column), F.col(source), "size"), "mix-sizes")
    else:
        sized = narrow = docs.withColumn("size", F.col(size).cast("long"))
    at = written(cuts(narrow, id_column, source, "size", **settings), "mix-cuts")
    order = F.struct(
        random_key(id_column), F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.col("size")
    )
    cut = F.struct("mix_cut_key", F.coalesce("mix_cut_id", F.lit("")), "mix_cut_size")
    last = (
        F.when(F.col("mix_cut_key").isNull(), F.lit(0))
        .when(order < cut, F.col("size"))
        .when(order == cut, F.col("mix_cut_gives"))
        .otherwise(0)
    )
    taken = (F.col("mix_passes") * F.col("size") + last).cast("long")
    return (
        sized.join(at, F.col(source).eqNullSafe(F.col("mix_source")))
        .withColumn("taken", taken)
        .drop("mix_source", "mix_passes", "mix_cut_key", "mix_cut_id", "mix_cut_size", "mix_cut_gives")
        .withColumnsRenamed({new: old for old, new in aside.items()})
    )
