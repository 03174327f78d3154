"""Number expressions."""

from pyspark.sql import Column, functions as F


def ratio(part: Column, whole: Column) -> Column:
    """part / whole in double precision, null for a zero or missing whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percentage(part: Column, whole: Column) -> Column:
    return F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def count_where(condition: Column) -> Column:
    """Rows for which the condition holds; 0 on empty input."""
    return F.count_if(condition)
