"""Windows along a key's order, also for keys too big for one task.

If some key has more rows than one task should sort, the rows are dealt out by ranges of
(key, order), which cuts a hot key's rows wherever a range is full. Each range has windows
of its own; what earlier ranges of a key carry over (a sum, a last state) comes from one
small row per key and range. Only keys that a cut divides get a carry, so there are at most
as many carries as ranges, and these are joined to the rows of their range.

Ranges cut between different values of the order only; end it with something unique where
many rows may be equal. Null keys are a key; nulls in the order come first.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trilayer.functions.exact import finite_amount, special_or, special_values
from trilayer.operators.joins import broadcast_if_small
from trilayer.workspace import written

# Rows of one key that one task sorts without trouble, and rows of a range.
RANGE_ROWS = 1_000_000
RANGE = "_range"


def in_ranges(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], range_rows: int = RANGE_ROWS
) -> DataFrame:
    """``df`` with the number of the range each row lies in; 0 throughout if no key has
    more than ``range_rows`` rows. Otherwise the result is a table of its own."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    rows, largest = sizes.agg(F.sum("_n"), F.max("_n")).first()
    if (largest or 0) <= range_rows:
        return df.withColumn(RANGE, F.lit(0))
    ranges = -(-rows // range_rows)
    dealt = df.repartitionByRange(ranges, *keys, *order)
    return written(dealt.withColumn(RANGE, F.spark_partition_id()), "ranges")


def _local(keys: Sequence[str], order: Sequence[str]) -> Window:
    return Window.partitionBy(RANGE, *keys).orderBy(*order)


def _carried(
    placed: DataFrame,
    keys: Sequence[str],
    totals: Mapping[str, Column],
    carries: Mapping[str, Callable[[Window], Column]],
    later: bool = False,
) -> DataFrame:
    """Per key and range that has earlier (or ``later``) ranges of the key: what these
    carry, from the totals of each. Keys are renamed, to be joined."""
    ranges = Window.partitionBy(*keys).orderBy(F.col(RANGE).desc() if later else RANGE)
    before = ranges.rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(RANGE, *keys).agg(*[c.alias(name) for name, c in totals.items()])
    return (
        sums.withColumns(
            {"_before": F.count("*").over(before), **{n: c(before) for n, c in carries.items()}}
        )
        .filter("_before > 0")
        .select(
            F.col(RANGE).alias("_at"), *[F.col(k).alias(f"_key_{k}") for k in keys], *carries
        )
    )


def _with_carry(placed: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    same = [F.col(RANGE) == F.col("_at")]
    same += [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    return placed.join(broadcast_if_small(written(carried, "carries")), same, "left")


def _is_cut(placed: DataFrame) -> bool:
    """Whether in_ranges() dealt the rows out; it then gave them a table with ranges."""
    return placed.select(RANGE).filter(F.col(RANGE) > 0).limit(1).count() > 0


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: Mapping[str, tuple[str, str]],
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``df`` with totals of each key's rows from its first up to the current one.

    ``totals`` maps an output to ``(kind, column)``, the kind being sum, count, min or max.
    Sums add in decimal, as in functions.exact, and count NaN and infinities as a plain sum
    would; nulls are left out. Rows of equal ``order`` are taken in any order.
    """
    placed = in_ranges(df, keys, order, range_rows)
    parts: dict[str, tuple[Callable, Column, Callable]] = {}
    for output, (kind, column) in totals.items():
        if kind == "sum":
            parts[f"_{output}_sum"] = F.sum, finite_amount(column), F.sum
            for name, value in zip(("nan", "plus", "minus"), special_values(column)):
                parts[f"_{output}_{name}"] = F.max, value, F.max
        elif kind == "count":
            parts[f"_{output}_count"] = F.count, F.col(column), F.sum
        elif kind in ("min", "max"):
            best = F.min if kind == "min" else F.max
            parts[f"_{output}_{kind}"] = best, F.col(column), best
        else:
            raise ValueError(f"no running {kind}")
    here = _local(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = placed.withColumns({name: agg(value).over(here) for name, (agg, value, _) in parts.items()})
    cut = _is_cut(placed)
    if cut:
        carried = _carried(
            placed, keys,
            {name: agg(value) for name, (agg, value, _) in parts.items()},
            {name: (lambda w, n=name, m=merge: m(n).over(w)) for name, (_, _, merge) in parts.items()},
        )
        carried = carried.withColumnsRenamed({name: f"_c{name}" for name in parts})
        found = _with_carry(found, carried, keys)

    def both(name: str, join: Callable[[Column, Column], Column]) -> Column:
        return join(F.col(name), F.col(f"_c{name}")) if cut else F.col(name)

    def added(mine: Column, carry: Column) -> Column:
        return F.coalesce(mine + carry, mine, carry)

    outputs = {}
    for output, (kind, _) in totals.items():
        if kind == "sum":
            special = [
                F.coalesce(both(f"_{output}_{n}", F.greatest), F.lit(False))
                for n in ("nan", "plus", "minus")
            ]
            outputs[output] = special_or(both(f"_{output}_sum", added).cast("double"), *special)
        elif kind == "count":
            outputs[output] = both(f"_{output}_count", added)
        else:
            outputs[output] = both(f"_{output}_{kind}", F.least if kind == "min" else F.greatest)
    return found.withColumns(outputs).select(*df.columns, *outputs)


def last_state(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    state: str,
    output: str,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``output`` = the newest value of ``state`` that is not null, up to each row."""
    placed = in_ranges(df, keys, order, range_rows)
    here = _local(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = placed.withColumn(output, F.last(state, ignorenulls=True).over(here))
    if _is_cut(placed):
        place = F.when(F.col(state).isNotNull(), F.struct(*order))
        carried = _carried(
            placed, keys, {"_carry": F.max_by(state, place)},
            {"_carry": lambda w: F.last("_carry", ignorenulls=True).over(w)},
        )
        found = _with_carry(found, carried, keys).withColumn(output, F.coalesce(output, "_carry"))
    return found.select(*df.columns, output)


def next_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    output: str,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``output`` = ``value`` of the key's next row in the order; null after the last."""
    placed = in_ranges(df, keys, order, range_rows)
    window = _local(keys, order)
    boxed = F.lead(F.struct(value)).over(window)
    found = placed.withColumn("_next", boxed)
    if _is_cut(placed):
        carried = _carried(
            placed, keys, {"_carry": F.min_by(F.struct(value), F.struct(*order))},
            {"_carry": lambda w: F.last("_carry").over(w)}, later=True,
        )
        found = _with_carry(found, carried, keys).withColumn("_next", F.coalesce("_next", "_carry"))
    return found.withColumn(output, F.col("_next")[value]).select(*df.columns, output)
