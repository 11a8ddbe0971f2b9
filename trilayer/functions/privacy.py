"""Hashing, masking, tokens and generalising of personal data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilayer.operators.joins import broadcast_if_small

# What counts as an e-mail address and a phone number in free text.
# An address begins where a run of its characters does, or the last match ended, and such
# a run is never tried again from its middle; so matching stays linear without limits.
_LOCAL = r"[\p{L}\p{M}\p{N}._%+-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[\p{{L}}\p{{M}}\p{{N}}.-]+\.\p{{L}}{{2,}}"
# With a country (+44 20 7946 0958, +1 (212) 555-1234), with an area ((212) 555-1234,
# 212-555-1234), or short (555-1234); not inside a longer number or word.
PHONE = (
    r"(?<![\p{L}\p{N}.+-])(?:"
    r"\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\))?(?:[ .-]?[0-9]{2,4}){2,4}"
    r"|(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[.-])?[0-9]{3}-[0-9]{4}"
    r")(?![\p{L}\p{N}]|[.-][0-9])"
)


# Text that every match contains; texts without it need no matching.
EMAIL_PART = "@"


def matches(text: str, pattern: str, part: str | None = None) -> Column:
    """All matches in the whole text; null if it lacks ``part``."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    return F.when(F.contains(F.col(text), F.lit(part)), found) if part else found


def extract_matches(
    df: DataFrame, keep: Sequence[str], text: str, pattern: str, part: str | None, output: str
) -> DataFrame:
    """One row per match in the whole text, numbered from 0 as ``position``."""
    found = matches(text, pattern, part)
    return df.select(*keep, F.posexplode(found).alias("position", output))


def hash_pii(value: Column, salt: str = "") -> Column:
    """SHA-256 of value followed by salt, in hex; null stays null."""
    return F.sha2(F.concat(value, F.lit(salt)) if salt else value, 256)


def mask_email(value: Column) -> Column:
    """First character, ``***`` and the domain. Without an ``@`` no domain is shown."""
    at = F.position(F.lit("@"), value)
    domain = F.when(at > 0, F.substr(value, at)).otherwise("")
    first = F.when(at == 1, "").otherwise(F.left(value, F.lit(1)))
    return F.concat(first, F.lit("***"), domain)


def mask_phone(value: Column) -> Column:
    """Every digit but the last four becomes X; other characters stay."""
    return F.regexp_replace(value, r"[0-9](?=(?:[^0-9]*[0-9]){4})", "X")


def token(value: Column, secret: str) -> Column:
    """A token that is the same for equal values and tells nothing without the key."""
    digest = F.sha2(F.concat(F.lit(secret), value), 256)
    return F.concat(F.lit("tok_"), F.left(digest, F.lit(32)))


def tokenize(
    df: DataFrame,
    column: str,
    secret: str,
    vault: DataFrame | None = None,
    output: str = "token",
) -> DataFrame:
    """``column`` as a token; values the vault knows keep the vault's token.

    ``vault`` has the columns value and token; rows may repeat, but a value with two tokens
    ends the job. Without one, nothing is joined.
    """
    fresh = token(F.col(column), secret)
    if vault is None:
        return df.withColumn(output, fresh)
    stop = F.raise_error("a value has two tokens in the vault").cast("string")
    known = vault.groupBy(F.col("value").alias("_value")).agg(
        F.when(F.min("token") == F.max("token"), F.min("token")).otherwise(stop).alias("_token")
    )
    known = broadcast_if_small(known)
    return df.join(known, F.col(column) == F.col("_value"), "left").select(
        *df.columns, F.coalesce("_token", fresh).alias(output)
    )


def new_vault_rows(
    df: DataFrame, column: str, secret: str, vault: DataFrame | None = None
) -> DataFrame:
    """Distinct values that the vault lacks, with their tokens, to be appended to it.

    Ends the job if two values got the same token.
    """
    values = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("value"))
    values = values.distinct()
    if vault is not None:
        values = values.join(vault, "value", "left_anti")
    stop = F.raise_error("two values have the same token").cast("boolean")
    return (
        values.groupBy(token(F.col("value"), secret).alias("token"))
        .agg(F.count("*").alias("_n"), F.any_value("value").alias("value"))
        .filter(F.when(F.col("_n") == 1, True).otherwise(stop))
        .select("value", "token")
    )


def generalise(value: Column, width: float) -> Column:
    """The lower end of the range of ``width`` that the value falls into."""
    return F.floor(value / width) * width


def suppress_rare(df: DataFrame, keys: Sequence[str], column: str, k: int) -> DataFrame:
    """``column`` as null where fewer than ``k`` rows share it and ``keys``.

    Only the rare groups are joined back, by broadcast if they are measured to be few.
    """
    group = [*keys, column]
    rare = (
        df.groupBy(*group)
        .count()
        .filter(F.col("count") < k)
        .select(*[F.col(name).alias(f"_g_{name}") for name in group], F.lit(True).alias("_rare"))
    )
    same = [F.col(name).eqNullSafe(F.col(f"_g_{name}")) for name in group]
    kept = F.when(F.col("_rare").isNull(), F.col(column)).alias(column)
    return df.join(broadcast_if_small(rare), same, "left").select(
        *[kept if name == column else F.col(name) for name in df.columns]
    )
