"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

KEY_SEPARATOR = "\u001f"


def canonical_customer(customer: Column, main_customer: Column) -> Column:
    """The trimmed customer id; the trimmed main id where it is missing or '0'."""
    own = F.trim(customer)
    return F.when(own.isNull() | (own == "0"), F.trim(main_customer)).otherwise(own)


def safe_long(text: Column) -> Column:
    """The number in a text, NULL where it is not a whole number."""
    return text.try_cast("bigint")


def transaction_key(*parts: Column, strict: bool = False) -> Column:
    """One text per transaction; NULL when any part is NULL.

    Without ``strict`` the parts are joined with nothing in between, so that
    neighbouring numbers can run together (document 1, store 23 and document 12,
    store 3 on one day are one transaction). ``strict`` keeps them apart.
    """
    texts = [p.cast("string") for p in parts]
    if not strict:
        return F.concat(*texts)
    spaced = [texts[0]]
    for text in texts[1:]:
        spaced += [F.lit(KEY_SEPARATOR), text]
    return F.concat(*spaced)


def month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def months_between_calendar(later: Column, earlier: Column) -> Column:
    """Month boundaries crossed, regardless of the day in the month."""
    return month_number(later) - month_number(earlier)


def period_end(period: Column) -> Column:
    """First day of a YYYYMM period: the exclusive end of its history window."""
    return F.to_date(F.concat(period.cast("string"), F.lit("01")), "yyyyMMdd")


def period_start(period: Column, months: int) -> Column:
    return F.add_months(period_end(period), -months)


def period_last_day(period: Column) -> Column:
    return F.date_sub(period_end(period), 1)


def store_label(location: Column, strict: bool = False) -> Column:
    """Three characters: longer numbers lose their end, unless ``strict`` keeps them whole."""
    text = location.cast("string")
    short = F.lpad(text, 3, "0")
    return F.when(F.length(text) > 3, text).otherwise(short) if strict else short


def two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def hour_of(timestamp_text: Column) -> Column:
    """The hour in a timestamp text, NULL where it cannot be read."""
    return F.hour(timestamp_text.try_cast("timestamp_ntz"))


def weekday_label(day: Column) -> Column:
    """Sunday is 01."""
    return two_digits(F.dayofweek(day))


def like_any(name: Column, patterns: Iterable[str]) -> Column:
    """True when the name is LIKE one of the patterns; no pattern means every name."""
    tests = [name.like(p) for p in patterns]
    return reduce(or_, tests) if tests else F.lit(True)


def stable_hash(key: Column, seed: int, purpose: str) -> Column:
    """A hexadecimal hash that depends on the key, the seed and the purpose alone.

    It replaces random numbers: the order and the share it gives do not change
    with partitioning, retries or the number of executors. Steps that draw one after
    the other need different purposes, or the later draw would follow the earlier one.
    """
    return F.md5(F.concat(key, F.lit(f":{seed}:{purpose}")))


def hash_below(key: Column, seed: int, purpose: str, share: float) -> Column:
    """True for about ``share`` of the keys, always the same ones."""
    if share >= 1.0:
        return F.lit(True)
    bound = int(share * 16**8)
    return F.substring(stable_hash(key, seed, purpose), 1, 8) < f"{bound:08x}"
