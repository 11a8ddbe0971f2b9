"""As-of join: the state that held when a row happened."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trilayer.operators.ranged import RANGE_ROWS, last_state


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    within: str | None = None,
    strictly_before: bool = False,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Every row of ``left`` with ``values`` of the newest row of ``right`` that has the
    same keys and a time not later than its own (earlier, if ``strictly_before``).

    ``within``, an interval such as "7 days", is how old that row may be; older ones give
    nulls, as do rows without one, without a key or without a time. Of several rows of one
    key and time the largest values count. Values are renamed only by the caller; a name
    that ``left`` has already is refused.

    Both sides are merged into one timeline per key, along which the newest state is
    carried; nothing is compared pair by pair, and a key that holds most of the rows is cut
    into ranges (operators.ranged).
    """
    clash = {*values} & {*left.columns}
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    has_place = F.col(left_time).isNotNull()
    for key in keys:
        has_place = has_place & F.col(key).isNotNull()
    sound = F.col(right_time).isNotNull()
    for key in keys:
        sound = sound & F.col(key).isNotNull()
    state = F.struct(*values, F.col(right_time).alias("_since"))
    kind = dict(left.dtypes)[left_time]
    named = [F.col(key).alias(f"_k{i}") for i, key in enumerate(keys)]
    timeline = [f"_k{i}" for i in range(len(keys))]
    questions = left.filter(has_place).select(
        *named, F.col(left_time).alias("_time"), F.lit(0 if strictly_before else 1).alias("_side"),
        F.xxhash64(left_time, *keys, *_hashable(left)).alias("_tie"), F.struct(*left.columns).alias("_row"),
    )
    states = right.filter(sound).select(
        *named, F.col(right_time).cast(kind).alias("_time"),
        F.lit(1 if strictly_before else 0).alias("_side"), state.alias("_state"),
    )
    merged = questions.unionByName(states, allowMissingColumns=True)
    found = last_state(
        merged, timeline, ["_time", "_side", "_state", "_tie"], "_state", "_found", range_rows
    ).filter(F.col("_row").isNotNull())
    if within:
        fresh = F.col("_found._since").cast(kind) + F.expr(f"interval {within}") >= F.col("_time")
        found = found.withColumn("_found", F.when(fresh, F.col("_found")))
    answers = found.select("_row.*", *[F.col(f"_found.{name}").alias(name) for name in values])
    rest = left.filter(~F.coalesce(has_place, F.lit(False))).select(
        "*", *[F.lit(None).cast(right.schema[name].dataType).alias(name) for name in values]
    )
    return answers.unionByName(rest)


def _hashable(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if "map<" not in kind and kind != "variant"]
