"""Date-as-text helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions._col import as_col


def year_from_text(c) -> Column:
    """Year of a ``YYYY-MM-DD`` text: integer before the first '-', 0 when missing or bad."""
    c = as_col(c)
    return F.coalesce(F.split_part(c, F.lit("-"), F.lit(1)).try_cast("int"), F.lit(0))


# Timestamp text is built from the cast to string (or to date), not ``date_format``: a
# ``TIMESTAMP_NTZ`` then renders its wall-clock value with no time zone involved, while
# ``date_format`` first turns it into an instant of the session zone, which moves the wall
# times that a daylight-saving jump skips.  A zoned ``TIMESTAMP`` renders in the session zone
# either way.  (Years 0001-9999.)

def stamp_text(ts) -> Column:
    """``%Y-%m-%d %H:%M:%S`` text of a timestamp."""
    return F.substring(as_col(ts).cast("string"), 1, 19)


def date_text(ts) -> Column:
    """``%Y-%m-%d`` text of a timestamp or date."""
    return as_col(ts).cast("date").cast("string")


def micros_text(ts) -> Column:
    """``%Y-%m-%d %H:%M:%S.%f`` text of a timestamp (always six fraction digits)."""
    c = as_col(ts)
    sec = F.date_part(F.lit("SECOND"), c)
    micros = ((sec - F.floor(sec)) * F.lit(1_000_000)).cast("int")
    return F.concat(stamp_text(c), F.lit("."), F.lpad(micros.cast("string"), 6, "0"))
