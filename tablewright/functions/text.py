"""Text expressions: normalising, null tokens, embedded numbers, age ranges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing category after lower-casing and stripping.
NULL_TOKENS = ("nan", "none", "null", "")

# Age ranges (lowest age, highest age, label); no upper bound is None.
AGE_RANGES = ((16, 25, "16-25"), (26, 39, "26-39"), (40, 64, "40-64"), (65, None, "65+"))

# The characters that count as white space at the edges of a text.
_EDGE_SPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
               "\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def normalise_text(c: Column) -> Column:
    """Text in lower case without leading and trailing white space of any kind."""
    return F.btrim(F.lower(c.cast("string")), F.lit(_EDGE_SPACE))


def null_tokens(c: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """NULL where the text is one of ``tokens``."""
    return F.when(~c.isin(list(tokens)), c) if tokens else c


def first_integer(c: Column) -> Column:
    """First run of digits as decimal(38,0); NULL without digits.

    A run of more than 38 digits is clamped, so that a long number stays a large number.
    """
    digits = F.regexp_replace(F.regexp_extract(c.cast("string"), r"\d+", 0), "^0+(?=.)", "")
    fits = F.when(F.length(digits) > 38, F.lit("9" * 38)).otherwise(digits)
    return F.nullif(fits, F.lit("")).try_cast("decimal(38,0)")


def age_bucket(c: Column, valid: Sequence[str], ranges=AGE_RANGES) -> Column:
    """Keep a valid label; otherwise put the first number of the text into its range."""
    n = first_integer(c)
    bucket = F.lit(None).cast("string")
    for low, high, label in reversed(ranges):
        inside = n >= low if high is None else (n >= low) & (n <= high)
        bucket = F.when(inside, F.lit(label)).otherwise(bucket)
    return keep_members(F.when(c.isin(list(valid)), c).otherwise(bucket), valid)


def keep_members(c: Column, valid: Sequence) -> Column:
    """NULL where the value is not in the valid list."""
    return F.when(c.isin(list(valid)), c)


def map_values(c: Column, mapping: Mapping, unmapped: float = 0.0) -> Column:
    """Dictionary look-up to double; missing and unmapped values become ``unmapped``."""
    if not mapping:
        return F.lit(float(unmapped))
    pairs = [F.lit(x) for k, v in mapping.items() for x in (k, float(v))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), F.lit(float(unmapped)))


def category_text(c: Column) -> Column:
    """Text of a category; a missing value is the category ``nan``."""
    return F.coalesce(c.cast("string"), F.lit("nan"))
