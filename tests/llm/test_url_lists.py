from __future__ import annotations

import random

import pytest

from trilayer.llm import url_lists
from trilayer.llm.url_lists import BUCKET, evaluate

CAPTURES = "page_id long, url string, fetched_at long, list string"
ENTRIES = "list string, pattern string, action string, at long, url string"


def wanted(url):
    if not url or "://" not in url:
        return set()
    rest = url.split("://", 1)[1]
    for mark in "?#":
        rest = rest.split(mark)[0]
    name, _, tail = rest.partition("/")
    name = name.split("@")[-1].split(":")[0].lower()
    if not name:
        return set()
    labels, steps = name.split("."), [s for s in tail.split("/") if s]
    return ({f"host:{name}"} | {"domain:" + ".".join(labels[k:]) for k in range(len(labels))}
            | {f"prefix:{name}/" + "/".join(steps[:k]) for k in range(1, len(steps) + 1)})


def brute_force(captures, entries):
    out = []
    for key in captures:
        page, url, at = key
        active = set()
        if at is not None:
            for name, pattern in {(e[0], e[1]) for e in entries if None not in e}:
                past = [(e[3], e[2] == "add") for e in entries
                        if None not in e and e[:2] == (name, pattern)
                        and e[2] in ("add", "remove") and e[3] <= at]
                if past and max(past)[1] and pattern in wanted(url):
                    active.add(f"{name} {pattern}")
        out.append((page, url, at, bool(active), len(active), sorted(active)))
    return sorted(out, key=str)


def run(spark, captures, entries, **settings):
    left = spark.createDataFrame([(*c, "x") for c in captures], CAPTURES)
    right = spark.createDataFrame([(*e, "x") for e in entries], ENTRIES)
    return sorted((tuple(r) for r in evaluate(left, right, **settings).collect()), key=str)


def test_edges(spark):
    t = 40 * BUCKET
    entries = [
        ("a", "host:x.org", "add", t), ("a", "host:x.org", "remove", t + 5 * BUCKET + 7),
        ("a", "host:x.org", "add", t + 9 * BUCKET), ("a", "host:x.org", "add", t + 9 * BUCKET),
        ("b", "domain:org", "add", t + 3), ("b", "prefix:x.org/p/q", "add", t + 1),
        ("b", "prefix:x.org/p/q", "remove", t + 1), ("b", "host:gone.org", "remove", t),
        ("c", None, "add", t), (None, "host:x.org", "add", t), ("c", "host:x.org", "other", t),
        ("c", "host:x.org", "add", None),
    ]
    urls = ["http://X.org/p/q/r?u", "https://sub.x.org:8/p", "http://u@x.org", "x.org/p", None,
            "", "http:///p", "http://x.org/" + "s/" * 500, "http://gone.org/p/q"]
    times = [t - 1, t, t + 1, t + 3, t + 5 * BUCKET + 6, t + 5 * BUCKET + 7, t + 8 * BUCKET,
             t + 9 * BUCKET, t + 30 * BUCKET, None]
    captures = [(i, u, at) for i, u in enumerate(urls) for at in times]
    captures += captures[:5] + [(None, urls[0], t)]
    assert run(spark, captures, entries) == brute_force(captures, entries)


@pytest.mark.parametrize("bucket", [10, BUCKET])
def test_random_histories(spark, bucket):
    draw = random.Random(3)
    names = ["host:a.com", "domain:com", "domain:a.com", "prefix:a.com/x", "host:b.a.com"]
    entries = [(draw.choice("lm"), draw.choice(names), draw.choice(["add", "remove"]),
                draw.randrange(200)) for _ in range(120)]
    urls = ["http://a.com/x/y", "http://b.a.com/", "http://c.com", "http://a.com"]
    captures = [(i, draw.choice(urls), draw.randrange(-5, 260)) for i in range(150)]
    assert run(spark, captures, entries, bucket=bucket) == brute_force(captures, entries)


def test_empty_tables(spark):
    one = [(1, "http://a.com/", 5)]
    assert run(spark, one, []) == [(1, "http://a.com/", 5, False, 0, [])]
    assert run(spark, [], [("l", "host:a.com", "add", 1)]) == []
    assert url_lists.BUCKET > 0


def test_times_in_milliseconds_and_microseconds(spark):
    """Captures far off make no rows for the time between."""
    entries = [("a", "host:x.org", "add", 10), ("a", "host:x.org", "remove", 10**12),
               ("b", "domain:org", "add", 5), ("b", "domain:org", "add", 1_704_067_200_000_000)]
    captures = [(i, "http://x.org/", at) for i, at in enumerate(
        [0, 11, 1_704_067_200, 1_704_067_200_000, 1_704_067_200_000_000, 2**62])]
    assert run(spark, captures, entries) == brute_force(captures, entries)
    asked = spark.createDataFrame(
        [("host:x.org", 11 // BUCKET), ("host:x.org", 2**40)], "pattern string, bucket long")
    found = url_lists.intervals(spark.createDataFrame([(*e, "") for e in entries], ENTRIES), asked)
    assert found.count() < 10


def test_repeated_captures_stay_apart(spark):
    entries = [("a", "host:x.org", "add", 10)]
    captures = [(1, "http://x.org/", 20)] * 3 + [(None, None, None)] * 2
    found = run(spark, captures, entries)
    assert len(found) == 5 and found == brute_force(captures, entries)
