"""Numeric cleaning, bucketing and counting expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pyspark.sql.types import DataType, IntegralType

from marquee.functions._col import as_col
from marquee.functions.text import strip_text


def to_number(c, spark_type: str) -> Column:
    """Lenient cast: text or numbers to ``spark_type``; anything unparsable is NULL.

    ANSI mode makes a plain ``cast`` raise on bad text, so ``try_cast`` is used.  For integer
    types the text of a decimal number gives its whole part (``2020.7`` is 2020), which
    ``try_cast`` alone would refuse.
    """
    c = as_col(c)
    plain = c.try_cast(spark_type)
    if spark_type not in ("tinyint", "smallint", "int", "long", "bigint"):
        return plain
    whole = F.regexp_extract(c.cast("string"), r"^\s*([+-]?\d+)\.\d*\s*$", 1)
    return F.coalesce(plain, F.when(whole != "", whole).try_cast(spark_type))


# What Python's int() and float() read, apart from digits of other scripts: no suffixes, and
# underscores only between digits.
_DIGITS = r"\d+(?:_\d+)*"
INT_TEXT = rf"^[+-]?{_DIGITS}$"
FLOAT_TEXT = rf"(?i)^[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?|nan|inf|infinity)$"


def number_of_text(c, spark_type: DataType) -> Column:
    """The number that a text spells, as ``int(text)`` or ``float(text)`` would read it, else NULL
    (also beyond the type's range)."""
    text = as_col(c)
    whole = isinstance(spark_type, IntegralType)
    c, pattern, digits = strip_text(text), INT_TEXT if whole else FLOAT_TEXT, r"\A-?[0-9]+\z" if whole else r"\A-?[0-9]+(\.[0-9]+)?\z"
    # bare digits, as nearly all numbers are written, need none of the trimming below
    return F.when(text.rlike(digits), text).when(c.rlike(pattern), F.replace(c, F.lit("_"), F.lit(""))).try_cast(spark_type)


def clamp_range(c, lo, hi, zero) -> Column:
    """Keep ``c`` when ``lo <= c <= hi``, else the sentinel ``zero`` (NULL and NaN included)."""
    c = as_col(c)
    cond = c.isNotNull()
    if lo is not None:
        cond = cond & (c >= F.lit(lo))
    if hi is not None:
        cond = cond & (c <= F.lit(hi))
    return F.when(cond, c).otherwise(F.lit(zero))


def floor_at(c, lo, zero) -> Column:
    """Keep ``c`` when ``c >= lo``, else ``zero`` (NULL included)."""
    return clamp_range(c, lo, None, zero)


def bucket_index(x, edges: Sequence[float]) -> Column:
    """0-based bucket of ``x`` for ascending ``edges``: lower edge inclusive, top open-ended.

    NaN sorts above every number in Spark, so it lands in the top bucket like Python's
    chain of ``<`` tests.
    """
    x = as_col(x)
    expr = F.lit(len(edges))
    for i in reversed(range(len(edges))):
        expr = F.when(x < F.lit(float(edges[i])), F.lit(i)).otherwise(expr)
    return expr


def bucket_label(x, edges: Sequence[float], labels: Sequence[str]) -> Column:
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    return F.element_at(F.array(*[F.lit(s) for s in labels]), bucket_index(x, edges) + 1)


def percent_of(n, total) -> Column:
    """``n / total * 100``, or 0 when the total is not positive (no ANSI divide-by-zero)."""
    n, total = as_col(n), as_col(total)
    return F.when(total > 0, n.cast("double") / total.cast("double") * F.lit(100.0)).otherwise(F.lit(0.0))


def count_distinct_with_null(c) -> Column:
    """``select(c).distinct().count()``: distinct values with NULL counted as one value."""
    c = as_col(c)
    return F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))


def unknown_name(key, prefix: str = "Unknown_") -> Column:
    """Fallback label ``f"{prefix}{key}"``; a NULL key renders as ``None`` like Python."""
    return F.concat(F.lit(prefix), F.coalesce(as_col(key).cast("string"), F.lit("None")))
