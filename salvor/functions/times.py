"""Time functions; every 'now' is a parameter. Sessions use UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: a date anywhere in a value, with or without separators and a time.
PUBLISHED = r"\d{4}[-/]?\d{2}[-/]?\d{2}(?:[T\s]?\d{2}:?(?:\d{2})?:?(?:\d{2})?)?"
STAMP = "yyyyMMddHHmmss"


def publication_timestamp(c: Column) -> Column:
    """The first date in a value as 14 digits, missing parts 00; null where no real date stands."""
    found = F.regexp_extract(c.cast("string"), PUBLISHED, 0)
    digits = F.rpad(F.regexp_replace(found, "[^0-9]", ""), 14, "0")
    return F.date_format(F.try_to_timestamp(F.when(found != "", digits), F.lit(STAMP)), STAMP)


def stamp_seconds(c: Column) -> Column:
    return F.unix_timestamp(F.try_to_timestamp(F.substring(c, 1, 14), F.lit(STAMP)))


def timestamp_distance(stamp: Column, target: Column) -> Column:
    """Seconds between two 14-digit stamps; without a target the newest is nearest; infinite where
    one can't be read."""
    apart = F.abs(stamp_seconds(stamp) - stamp_seconds(target)).cast("double")
    newest = -F.coalesce(F.try_to_number(F.nullif(stamp, F.lit("")), F.lit("9" * 14)).cast("double"), F.lit(0.0))
    return F.when(target.isNull(), newest).otherwise(F.coalesce(apart, F.lit(float("inf"))))


def retry_after(value: Column, now: Column, most: float) -> Column:
    """Seconds to wait, by number or HTTP date, within [0, most]; 0 where it can't be read."""
    number = value.try_cast("double")
    date = F.try_to_timestamp(F.regexp_replace(value, r"^[A-Za-z]+,\s*", ""), F.lit("dd MMM yyyy HH:mm:ss zzz"))
    wait = F.coalesce(number, (F.unix_timestamp(date) - F.unix_timestamp(now)).cast("double"), F.lit(0.0))
    return F.least(F.lit(float(most)), F.greatest(F.lit(0.0), wait))


def crawl_date(stamp: Column) -> Column:
    return F.to_date(F.try_to_timestamp(F.substring(stamp, 1, 8), F.lit("yyyyMMdd")))


def iso_utc(now: Column) -> Column:
    return F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def request_gap(rate: float) -> float:
    return 1.0 / rate


def ratio(a: Column, b: Column, empty: float | None = 0.0) -> Column:
    """a / b, or ``empty`` where b is 0 or null."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(empty).cast("double"))


def percent_complete(done: Column, total: Column) -> Column:
    return F.when(total == 0, 100.0).otherwise(F.try_divide(done * 100.0, total.cast("double")))
