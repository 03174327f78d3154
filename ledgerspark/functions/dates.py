"""Date expressions. No expression here reads the clock."""

from pyspark.sql import Column, functions as F

from ledgerspark.functions.text import strip

OPEN_END = "9999-12-31"
ISO_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"


def parse_date(text: Column) -> Column:
    """The day of an ISO date or date-time, or null; a year of five digits does not parse.

    Text of the shape ....-..-.d goes through the cast, which is several times
    faster than a pattern. Everything else is left to the strict pattern.
    """
    plain = F.trim(text)
    iso_shape = (
        (F.length(plain) == 10)
        & (F.substring(plain, 5, 1) == "-")
        & (F.substring(plain, 8, 1) == "-")
        & F.ascii(F.substring(plain, 10, 1)).between(ord("0"), ord("9"))
    )
    inner = strip(text)
    day_of_time = F.when(inner.rlike(ISO_TIME), inner.try_cast("timestamp_ntz").cast("date"))
    return F.when(iso_shape, plain.try_cast("date")).otherwise(
        F.coalesce(F.try_to_date(inner, "yyyy-MM-dd"), day_of_time)
    )


def date_key(day: Column) -> Column:
    """The day as the number yyyymmdd. It reads the day once, which may be an expression."""
    return F.replace(day.cast("string"), F.lit("-"), F.lit("")).cast("bigint")


def year_month(day: Column) -> Column:
    """yyyy-mm, cut off the ISO text of the date or time."""
    return F.substring(day.cast("string"), 1, 7)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def hours_between(start: Column, end: Column) -> Column:
    """Whole-second difference in hours; each side is floored to its second first."""
    return (F.unix_seconds(end) - F.unix_seconds(start)) / F.lit(3600.0)
