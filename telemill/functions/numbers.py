"""Strict text-to-number rules.

Every rule yields NULL for text it does not accept, never a default and never
an exception, so that a bad line stays visible and can be reported by column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a decimal number. Spark's own cast would also take Java
# literals such as `1.0d`, `1f` and `0x1p3`.
BLANKS = r"[\t-\r ]*"
FLOAT_PATTERN = (
    rf"^(?i){BLANKS}[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|nan|inf|infinity){BLANKS}\z"
)

# Spark's own cast to a whole number would also skip control characters around it.
WHOLE_PATTERN = rf"^{BLANKS}[+-]?\d+{BLANKS}\z"
CONTROL_PATTERN = r"[\x00-\x1f\x7f]"


def integer(text: Column, width: str = "int") -> Column:
    """Whole number of the given width (`smallint`, `int`, `bigint`).

    Surrounding blanks and a sign are fine; fractions, exponents, empty text
    and values that do not fit the width are not.
    """
    return F.when(text.rlike(WHOLE_PATTERN), text.try_cast(width))


def strict_fields(line: Column, fields: Column) -> Column:
    """The fields as whole numbers are to be read from: NULL where Spark's cast would be too lenient.

    Only lines with control characters can have such fields, so others are looked at once and not field by field.
    """
    strict = F.transform(fields, lambda x: F.when(x.rlike(WHOLE_PATTERN) | (x == "") | (x == "None"), x))
    return F.when(line.rlike(CONTROL_PATTERN), strict).otherwise(fields)


def float64(text: Column) -> Column:
    signed_nan = F.lower(F.trim(text)).isin("+nan", "-nan")
    return F.when(
        text.rlike(FLOAT_PATTERN),
        F.coalesce(text.try_cast("double"), F.when(signed_nan, F.lit(float("nan")))),
    )


def float32(text: Column) -> Column:
    """Parsed at 64 bits, then narrowed."""
    return float64(text).cast("float")

