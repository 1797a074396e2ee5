"""Numbers as the scoring rules need them."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round2(x: Column) -> Column:
    """Two decimals by the exact binary value, half to even; Spark's own round() goes by the decimal text."""
    return F.replace(F.format_number(x.cast("double"), 2), F.lit(","), F.lit("")).cast("double")


def text2(x: Column) -> Column:
    """round2() as text with two decimals."""
    return F.replace(F.format_number(x.cast("double"), 2), F.lit(","), F.lit(""))


def flags(*conditions: Column) -> Column:
    """How many conditions hold."""
    out = F.lit(0)
    for c in conditions:
        out = out + F.coalesce(c.cast("int"), F.lit(0))
    return out
