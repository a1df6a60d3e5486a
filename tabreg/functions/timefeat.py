"""Clock and label expressions, all built from JVM-side Column functions.

They stay inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..spec import DAY_PART_OTHER, DAY_PARTS

_INT_MIN = -2147483648.0
_INT_MAX = 2147483647.0


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(c: str | Column) -> Column:
    """Text or number to double; text that is not a number becomes null."""
    return _as_col(c).try_cast("double")


def truncate_to_int(t: Column) -> Column:
    """Double to int the JVM way: toward zero, NaN to 0, saturating."""
    clipped = F.least(F.greatest(F.nanvl(t, F.lit(0.0)), F.lit(_INT_MIN)), F.lit(_INT_MAX))
    return clipped.cast("int")


def minutes_from_parts(t: Column, i: Column) -> Column:
    """HHMM -> minutes from the parsed value ``t`` and its truncation ``i``.

    Split out so callers can project ``t`` and ``i`` once as columns and keep
    this CASE small (see ``tabreg.operators.clean.add_clock_features``).
    """
    a = F.abs(i)
    hours, minutes = F.floor(a / F.lit(100)), a % 100
    return (
        F.when(t.isNull(), F.lit(None))
        .when(i >= 0, hours * 60 + minutes)
        .when(i > -10, i)
        .when(i > -100, F.lit(None))
        .otherwise(-hours * 60 + minutes)
        .cast("double")
    )


def hhmm_to_minutes(c: str | Column) -> Column:
    """HHMM clock value to minutes since midnight, as double.

    The value is truncated to an integer and read as text: the last two
    digits are minutes and anything before them is hours, so 741 -> 461,
    2400 -> 1440, 5 -> 5. There is no range check. A negative value keeps
    its sign on the hour part only (-545 -> -255); between -99 and -10 the
    hour text is a bare sign and the result is null. Null stays null and
    NaN counts as 0.

    Written as integer arithmetic equal to that text rule, so it needs no
    string building per row.
    """
    t = as_double(c)
    return minutes_from_parts(t, truncate_to_int(t).cast("bigint"))


def day_part(c: str | Column) -> Column:
    """HHMM value to Morning / Afternoon / Evening (null stays null).

    [1, 1125] is Morning, (1125, 1750] Afternoon, anything else (0, below 1,
    above 1750, NaN) Evening.
    """
    t = as_double(c)
    (first, lo1, hi1), (second, lo2, hi2) = DAY_PARTS
    return (
        F.when(t.isNull(), F.lit(None).cast("string"))
        .when((t >= lo1) & (t <= hi1), F.lit(first))
        .when((t > lo2) & (t <= hi2), F.lit(second))
        .otherwise(F.lit(DAY_PART_OTHER))
    )


def cube_root(c: str | Column) -> Column:
    """Sign-preserving cube root as double (cube_root(-8) = -2)."""
    return F.cbrt(_as_col(c)).cast("double")
