from __future__ import annotations

import hashlib
import re

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trilayer.functions import privacy


def people(spark):
    return spark.createDataFrame(
        [("Alice", "alice@example.com", "555-1234"), ("Bob", "bob@example.com", "555-5678")],
        "name string, email string, phone string",
    )


def one(spark, value, function):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(function(F.col("v"))).first()[0]


def test_hash(spark):
    assert one(spark, "a@b.de", privacy.hash_pii) == hashlib.sha256(b"a@b.de").hexdigest()
    salted = one(spark, "555", lambda c: privacy.hash_pii(c, "salt"))
    assert salted == hashlib.sha256(b"555salt").hexdigest()
    assert one(spark, None, lambda c: privacy.hash_pii(c, "salt")) is None


def test_masks(spark):
    masked = people(spark).select(
        privacy.mask_email(F.col("email")), privacy.mask_phone(F.col("phone"))
    )
    assert rows(masked) == [("a***@example.com", "XXX-1234"), ("b***@example.com", "XXX-5678")]


@pytest.mark.parametrize(
    ("value", "masked"),
    [("x@y.de", "x***@y.de"), ("@y.de", "***@y.de"), ("nobody", "n***"), ("", "***"), (None, None)],
)
def test_unusual_addresses(spark, value, masked):
    assert one(spark, value, privacy.mask_email) == masked


@pytest.mark.parametrize(
    ("value", "masked"),
    [
        ("+1 (743) 555-3824", "+X (XXX) XXX-3824"),
        ("12345678", "XXXX5678"),
        ("1234", "1234"),
        ("1-2-3-4-5", "X-2-3-4-5"),
        ("", ""),
        (None, None),
    ],
)
def test_phones(spark, value, masked):
    assert one(spark, value, privacy.mask_phone) == masked


@settings(
    max_examples=10,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(st.lists(st.text("0123456789-+ ()", max_size=20), min_size=1, max_size=20))
def test_no_more_than_four_digits_stay(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for before, after in df.select("v", privacy.mask_phone(F.col("v"))).collect():
        assert len(re.findall("[0-9]", after)) <= 4
        assert re.findall("[0-9]", after) == re.findall("[0-9]", before)[-4:]
        assert len(after) == len(before)


def test_whole_texts_are_searched(spark):
    filler = "x" * 50000
    text = f"{filler} one@a.org, two.b+c@mail.example.com. {filler} +1 (123) 555-0000 three@c.net"
    df = spark.createDataFrame([(1, text), (2, None), (3, "none")], "id int, text string")
    found = privacy.extract_matches(df, ["id"], "text", privacy.EMAIL, "@", "email")
    assert [tuple(row) for row in found.orderBy("position").collect()] == [
        (1, 0, "one@a.org"),
        (1, 1, "two.b+c@mail.example.com"),
        (1, 2, "three@c.net"),
    ]
    phones = privacy.extract_matches(df, ["id"], "text", privacy.PHONE, None, "phone")
    assert rows(phones) == [(1, 0, "+1 (123) 555-0000")]


def found(spark, text, pattern):
    df = spark.createDataFrame([(text,)], "text string")
    return df.select(privacy.matches("text", pattern)).first()[0]


@pytest.mark.parametrize(
    ("text", "emails"),
    [
        ("to " + "l" * 80 + "@a.org.", ["l" * 80 + "@a.org"]),
        ("bob@ex." + "x" * 40 + " ", ["bob@ex." + "x" * 40]),
        ("bob@" + "d." * 200 + "org", ["bob@" + "d." * 200 + "org"]),
        ("jürgen@example.com", ["jürgen@example.com"]),
        ("a@b.co.m-x@y.com", ["a@b.co", ".m-x@y.com"]),
        ("no@dot and @x.org", []),
        ("a@" * 2000, []),
    ],
)
def test_addresses_of_any_length_and_script(spark, text, emails):
    assert found(spark, text, privacy.EMAIL) == emails


@pytest.mark.parametrize(
    ("text", "phones"),
    [
        ("555-1234, 555-5678", ["555-1234", "555-5678"]),
        ("call (212) 555-1234!", ["(212) 555-1234"]),
        ("+44 20 7946 0958.", ["+44 20 7946 0958"]),
        ("+1 (743) 555-3824 or 212-555-1234", ["+1 (743) 555-3824", "212-555-1234"]),
        ("2024-01-15 152.143.123.131 4785380592391135 a555-1234 555-12345 1555-1234", []),
    ],
)
def test_phone_formats(spark, text, phones):
    assert found(spark, text, privacy.PHONE) == phones


def test_a_vault_with_repeated_rows(spark):
    df = spark.createDataFrame([("Alice",)], "name string")
    vault = spark.createDataFrame([("Alice", "tok_1"), ("Alice", "tok_1")], "value string, token string")
    assert rows(privacy.tokenize(df, "name", "k", vault)) == [("Alice", "tok_1")]
    torn = vault.union(spark.createDataFrame([("Alice", "tok_2")], vault.schema))
    with pytest.raises(Exception, match="two tokens"):
        privacy.tokenize(df, "name", "k", torn).collect()


def test_vault_and_rare_groups_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(privacy, "broadcast_if_small", lambda df: df)
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0)], "g string, v double")
    assert rows(privacy.suppress_rare(df, ["g"], "v", 2)) == [("a", 1.0), ("a", 1.0), ("b", None)]
    vault = spark.createDataFrame([("a", "tok_a")], "value string, token string")
    assert privacy.tokenize(df, "g", "k", vault).filter("token = 'tok_a'").count() == 2


def test_tokens_are_stable_and_kept_in_the_vault(spark):
    df = spark.createDataFrame([("Alice",), ("Bob",), ("Alice",), (None,)], "name string")
    tokens = {row["name"]: row["token"] for row in privacy.tokenize(df, "name", "k1").collect()}
    assert tokens[None] is None and tokens["Alice"] != tokens["Bob"]
    vault = privacy.new_vault_rows(df, "name", "k1")
    assert rows(vault) == sorted((n, t) for n, t in tokens.items() if n)
    # With another key, old values keep their token and only new ones are added.
    more = df.union(spark.createDataFrame([("Cleo",)], "name string"))
    again = {
        row["name"]: row["token"]
        for row in privacy.tokenize(more, "name", "k2", vault).collect()
    }
    assert again["Alice"] == tokens["Alice"] and again["Cleo"].startswith("tok_")
    assert [row[0] for row in rows(privacy.new_vault_rows(more, "name", "k2", vault))] == ["Cleo"]


def test_token_collisions_stop_the_job(spark, monkeypatch):
    monkeypatch.setattr(privacy, "token", lambda value, secret: F.left(value, F.lit(1)))
    df = spark.createDataFrame([("Ann",), ("Abe",)], "name string")
    with pytest.raises(Exception, match="same token"):
        privacy.new_vault_rows(df, "name", "k").collect()


def test_generalise_and_suppress(spark):
    df = spark.createDataFrame(
        [("a", 12.0), ("a", 17.0), ("a", 25.0), ("b", 12.0), (None, 12.0), (None, 13.0), ("b", None)],
        "g string, v double",
    ).withColumn("v", privacy.generalise(F.col("v"), 10))
    assert rows(privacy.suppress_rare(df, ["g"], "v", 2)) == [
        (None, 10),
        (None, 10),
        ("a", None),
        ("a", 10),
        ("a", 10),
        ("b", None),
        ("b", None),
    ]
