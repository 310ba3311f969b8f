"""Number and time expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def cents(amount: Column) -> Column:
    """An amount in whole cents, so that sums do not depend on their order."""
    return F.round(amount * 100).cast("bigint")


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone, read as UTC whatever the session's zone is."""
    of_day = (F.hour(ts) * 60 + F.minute(ts)).cast("bigint") * 60_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    return F.unix_date(ts.cast("date")).cast("bigint") * 86_400_000_000 + of_day


def day(ts: Column) -> Column:
    return F.to_date(ts)


def draw(key: Column, bound: int, seed: int) -> Column:
    """A whole number in [0, bound) fixed by key and seed, the same on every run."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(bound)).cast("bigint")


def doubled(value: Column) -> Column:
    return value * 2


def repeated(text: Column) -> Column:
    return F.concat(text, text)
