"""Text shaping that reproduces Python's ``str`` formatting rules with Spark built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions._col import as_col

# Python's str.strip() removes every character for which str.isspace() is true.  Java's
# Unicode \s covers the same set except the four information separators U+001C..U+001F,
# which are added to the class explicitly.
_PY_SPACE = r"[\s\x1c-\x1f]"
_STRIP_PATTERN = r"(?U)\A" + _PY_SPACE + r"+|" + _PY_SPACE + r"+\z"


def strip_text(c) -> Column:
    """Python ``s.strip()``: trim Unicode whitespace at both ends (NULL stays NULL)."""
    return F.regexp_replace(as_col(c), _STRIP_PATTERN, "")


def prefix(c, n: int) -> Column:
    """Python ``s[:n]`` by code point; no re-trim after the cut."""
    return F.substring(as_col(c), 1, n)


def fixed(x, decimals: int) -> Column:
    """Python ``"{:.Nf}".format(x)``: fixed-point text of the exact binary value.

    ``format_number`` with a pattern rounds half-even on the exact value like Python and
    does not group thousands; only the non-finite spellings differ and are mapped here.
    """
    x = as_col(x)
    pattern = "0." + "0" * decimals if decimals > 0 else "0"
    text = F.call_function("format_number", x.cast("double"), F.lit(pattern))
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(F.isnan(x), F.lit("nan"))
            .when(x == F.lit(float("inf")), F.lit("inf"))
            .when(x == F.lit(float("-inf")), F.lit("-inf"))
            .otherwise(text))


def py_round(x, decimals: int) -> Column:
    """Python ``round(x, n)`` for floats (round half-even on the exact binary value)."""
    x = as_col(x)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), x.cast("double")).otherwise(
        fixed(x, decimals).cast("double"))


def pad_right(c, width: int) -> Column:
    """Python ``f"{s:<w}"``: pad with spaces to ``width``; longer text is left whole."""
    c = as_col(c)
    return F.when(F.char_length(c) >= width, c).otherwise(F.rpad(c, width, " "))


def zero_pad(n, width: int) -> Column:
    """Python ``"{:0Wd}".format(n)`` for non-negative integers."""
    n = as_col(n)
    s = n.cast("string")
    return F.when(F.char_length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def thousands(n) -> Column:
    """Python ``"{:,}".format(n)`` for integers."""
    return F.format_number(as_col(n).cast("long"), 0)


def slug(c) -> Column:
    """``s.lower().replace(" ", "_")``: the source tag of a listing."""
    return F.replace(F.lower(as_col(c)), F.lit(" "), F.lit("_"))


def join_first(arr, n: int, sep: str = ", ") -> Column:
    """``sep.join(xs[:n])`` over an array column; NULL elements are skipped, NULL array → ''."""
    return F.coalesce(F.concat_ws(sep, F.slice(as_col(arr), 1, n)), F.lit(""))
