"""k-anonymity over several columns at once, by halving groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trilayer.operators.joins import broadcast_if_small
from trilayer.workspace import written


def mondrian(df: DataFrame, columns: Sequence[str], k: int, accuracy: int = 10_000) -> DataFrame:
    """``df`` with ``group`` and, per column, ``<column>_from`` and ``<column>_to``: ranges
    that at least ``k`` rows share.

    All rows begin as one group. In each round every group is cut at the median of the
    column in which it spreads most, measured by that column's spread over all rows, if both
    halves keep ``k`` rows; otherwise the next column is tried, and a group that none can cut
    is done. Columns are numbers, dates or times. Nulls (and NaN) come before all values, and
    a range that begins with them begins with null. With fewer than ``k`` rows in all there
    is one group, which is too small: its ranges are null. Rounds are about log2(rows / k);
    each is one aggregate for medians, one for counts and one written table.
    """
    places = {name: f"_p{i}" for i, name in enumerate(columns)}
    lowest = F.lit(float("-inf"))
    kinds = dict(df.dtypes)

    def place(name: str):
        column = F.col(name)
        if kinds[name] in ("timestamp", "timestamp_ntz"):
            column = F.unix_micros(column.cast("timestamp"))
        elif kinds[name] == "date":
            column = F.unix_date(column)
        number = column.cast("double")
        return F.when(number.isNull() | F.isnan(number), lowest).otherwise(number)

    rows = df.withColumns({p: place(name) for name, p in places.items()})
    rows = written(rows.withColumns({"group": F.lit(1).cast("long"), "_open": F.lit(True)}), "mondrian-rows")
    whole = rows.agg(F.count("*").alias("n"), *[
        (F.max(p) - F.min(F.when(F.col(p) > lowest, F.col(p)))).alias(p) for p in places.values()
    ]).first()
    while rows.filter("_open").limit(1).count():
        middles = rows.filter("_open").groupBy("group").agg(*[
            part for p in places.values() for part in (
                F.percentile_approx(p, 0.5, accuracy).alias(f"{p}_mid"),
                (F.max(p) - F.min(F.when(F.col(p) > lowest, F.col(p)))).alias(f"{p}_spread"),
            )
        ])
        middles = broadcast_if_small(written(middles, "mondrian-medians"))
        named = rows.filter("_open").join(middles, "group")
        sides = named.groupBy("group", *middles.columns[1:]).agg(F.count("*").alias("n"), *[
            F.count_if(F.col(p) <= F.col(f"{p}_mid")).alias(f"{p}_low") for p in places.values()
        ])
        choices = F.array(*[
            F.struct(
                (F.coalesce(F.col(f"{p}_spread"), F.lit(0.0)) / F.lit(whole[p] or 1.0)).alias("spread"),
                F.lit(-i).alias("place"), F.col(f"{p}_mid").alias("cut"),
                ((F.col(f"{p}_low") >= k) & (F.col("n") - F.col(f"{p}_low") >= k)).alias("fits"),
            ) for i, p in enumerate(places.values())
        ])
        best = F.array_max(F.filter(choices, lambda c: c["fits"]))
        cuts = written(sides.select("group", best.alias("cut")), "mondrian-cuts")
        joined = rows.join(broadcast_if_small(cuts), "group", "left")
        value = F.element_at(F.array(*places.values()), 1 - F.col("cut.place"))
        half = F.when(value <= F.col("cut.cut"), 0).otherwise(1)
        is_cut = F.col("cut").isNotNull()
        rows = written(
            joined.select(
                *[c for c in rows.columns if c not in ("group", "_open")],
                F.when(is_cut, 2 * F.col("group") + half).otherwise(F.col("group")).alias("group"),
                (F.col("_open") & is_cut).alias("_open"),
            ),
            "mondrian-rows",
        )
    value = {name: F.when(F.col(p) > lowest, F.col(name)) for name, p in places.items()}
    bounds = rows.groupBy("group").agg(F.count("*").alias("_n"), *[
        part for name, p in places.items() for part in (
            F.when(F.min(p) > lowest, F.min(value[name])).alias(f"{name}_from"),
            F.max(value[name]).alias(f"{name}_to"),
        )
    ])
    enough = F.col("_n") >= k
    bounds = bounds.select("group", *[
        F.when(enough, F.col(c)).alias(c) for name in columns for c in (f"{name}_from", f"{name}_to")
    ])
    bounds = broadcast_if_small(written(bounds, "mondrian-bounds"))
    return rows.drop("_open", *places.values()).join(bounds, "group").select(
        *df.columns, "group", *bounds.columns[1:])
