"""Daily sketches that longer periods are merged from, without another scan.

A day keeps, beside its row count, a HyperLogLog sketch per counted column and a KLL sketch
per measured column. Sketches of days make those of months and of everything; each is a few
kilobytes however many rows it stands for. Estimates may differ between runs, within their
errors: publish them as estimates, or whether they are within.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilayer.functions.exact import is_finite
from trilayer.operators.gold import day

#: log2 of the HyperLogLog registers; the standard error is 1.04 / sqrt(2**LG_K), 0.8 %.
LG_K = 14
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)
#: Size of a KLL sketch. Ranks are within 0.35 % with a chance of 99 %; RANK_ERROR is three
#: times as much, which makes a miss next to impossible.
KLL_K = 1024
RANK_ERROR = 0.0105


def daily_sketches(
    rows: DataFrame, distinct: Sequence[str], measured: Sequence[str],
    time: str = "tpep_pickup_datetime",
) -> DataFrame:
    """Per day: trip_date, trips, ``<column>_hll`` and ``<column>_kll``. Nulls are not
    counted; NaN and infinities have no rank and are left out of KLL sketches."""
    return rows.groupBy(day(time).alias("trip_date")).agg(
        F.count("*").alias("trips"),
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LG_K)).alias(f"{c}_hll") for c in distinct],
        *[
            F.kll_sketch_agg_double(
                F.when(is_finite(F.col(c)), F.col(c).cast("double")), F.lit(KLL_K)
            ).alias(f"{c}_kll")
            for c in measured
        ],
    )


def merged(sketches: DataFrame, period: Column, output: str = "period") -> DataFrame:
    """Sketches of longer periods: ``period`` is an expression over trip_date. Merging is
    an aggregate with partial sums, and merged sketches can be merged again."""
    return sketches.groupBy(period.alias(output)).agg(
        F.sum("trips").alias("trips"),
        *[F.hll_union_agg(c).alias(c) for c in sketches.columns if c.endswith("_hll")],
        *[F.kll_merge_agg_double(c).alias(c) for c in sketches.columns if c.endswith("_kll")],
    )


def distinct_estimate(column: str) -> Column:
    """Distinct values of the column, to within DISTINCT_ERROR (three standard errors)."""
    return F.hll_sketch_estimate(f"{column}_hll")


def quantile_estimate(column: str, rank: float) -> Column:
    """A value whose rank is ``rank``, to within RANK_ERROR; null if there were none."""
    sketch = F.col(f"{column}_kll")
    return F.when(
        F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(rank))
    )
