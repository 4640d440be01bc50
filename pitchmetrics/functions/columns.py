"""Column-expression helpers.  All are built-in Spark expressions (JVM side,
whole-stage codegen); none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tag_mask(tag_bits: dict[int, int], tags: str | Column = "tags") -> Column:
    """OR of the bit of every listed tag id present (ids compared by ``id`` only).
    Each id is one ``array_contains``, which is compiled; a lambda over the array is
    interpreted, event by event."""
    ids = (F.col(tags) if isinstance(tags, str) else tags)["id"]
    mask = F.lit(0)
    for tag_id, b in tag_bits.items():
        mask = mask.bitwiseOR(F.when(F.array_contains(ids, tag_id), F.lit(b)).otherwise(F.lit(0)))
    return mask


def has_bit(mask: str | Column, b: int) -> Column:
    mask = F.col(mask) if isinstance(mask, str) else mask
    return mask.bitwiseAND(F.lit(b)) != 0


def is_tagged(tags: str | Column = "tags") -> Column:
    """The event carries at least one tag (tag-based metrics require it)."""
    tags = F.col(tags) if isinstance(tags, str) else tags
    return F.coalesce(F.size(tags) > 0, F.lit(False))


def count_if(cond: Column) -> Column:
    """Count of rows where ``cond`` holds, as BIGINT (algebraic: partial-aggregates)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def ratio(num: Column, den: Column) -> Column:
    """num/den as DOUBLE; 0.0 for a zero or missing denominator (ANSI-safe)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def parse_count(value: str | Column) -> Column:
    """A string-typed count such as ``"2"``, ``"0"`` or ``"null"`` as INT; NULL when not a number."""
    value = F.col(value) if isinstance(value, str) else value
    return F.trim(value.cast("string")).try_cast("int")


def parse_date(value: str | Column) -> Column:
    """A date written as text, as DATE; NULL when it is not one."""
    value = F.col(value) if isinstance(value, str) else value
    return value.cast("string").try_cast("date")


def match_date_of(dateutc: str | Column) -> Column:
    """Match date from a UTC timestamp string: its first 10 characters, NULL where they
    are no date."""
    dateutc = F.col(dateutc) if isinstance(dateutc, str) else dateutc
    return parse_date(F.substring(dateutc, 1, 10))


def age_days(on_date: str | Column, birth_date: str | Column) -> Column:
    """Whole days between birth and a date."""
    return F.datediff(F.col(on_date) if isinstance(on_date, str) else on_date,
                      F.col(birth_date) if isinstance(birth_date, str) else birth_date)


def stable_round(c: str | Column, digits: int = 6) -> Column:
    """Round for result comparison: nudged off exact decimal ties first, so that
    engines with different tie rules agree.  Used by the query catalogue only."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double") + F.lit(1e-9), digits) + F.lit(0.0)  # + 0.0 turns -0.0 into 0.0
