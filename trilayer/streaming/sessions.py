"""Streams joined with each other, freed of repeats, and cut into sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    within: str,
    left_delay: str,
    right_delay: str,
    how: str = "inner",
) -> DataFrame:
    """Rows of two streams with equal keys, the right one not before the left and at most
    ``within`` after it.

    Both sides have a watermark, so each keeps only the rows that the other may still need:
    the left side those up to ``within`` behind the right's watermark. With ``how="left"`` a
    left row without a partner comes once its time is over. Key columns come once; other
    names of the two sides must differ. Rows later than the delays find no partner once its
    state is gone; nothing that comes in time is missed.
    """
    clash = ({*left.columns} & {*right.columns}) - {*keys}
    if clash:
        raise ValueError(f"both streams have {sorted(clash)}")
    a = left.withWatermark(left_time, left_delay).alias("a")
    b = right.withWatermark(right_time, right_delay).alias("b")
    begin, moment = F.col(f"a.{left_time}"), F.col(f"b.{right_time}")
    on = (moment >= begin) & (moment <= begin + F.expr(f"interval {within}"))
    for key in keys:
        on = on & (F.col(f"a.{key}") == F.col(f"b.{key}"))
    return a.join(b, on, how).select(
        *[F.col(f"a.{name}") for name in left.columns],
        *[F.col(f"b.{name}") for name in right.columns if name not in keys],
    )


def distinct_events(events: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Each event once, by its keys, if its repeats come within ``delay`` of event time;
    the state of an event is dropped after that."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([*keys])


def sessions(
    events: DataFrame, key: str, time: str, gap: str, event_key: Sequence[str], delay: str
) -> DataFrame:
    """Sessions of each key: session_start, session_end (``gap`` after the last event) and
    events. Repeated events count once; a session is given out when the watermark, ``delay``
    behind the newest event, has passed its end."""
    once = distinct_events(events, event_key, time, delay)
    return (
        once.groupBy(F.session_window(time, gap).alias("session"), key)
        .agg(F.count("*").alias("events"))
        .select(
            F.col(key), F.col("session.start").alias("session_start"),
            F.col("session.end").alias("session_end"), "events",
        )
    )
