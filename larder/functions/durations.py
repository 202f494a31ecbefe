"""ISO-8601 durations as native column expressions.

Spark has no function for this text form. One regular expression decides
whether the text is a duration at all; the numbers are then cut out with plain
substring functions, which cost a fraction of a regexp capture per unit. All of
it stays inside whole-stage code generation.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit letter, seconds per unit, the letters that may stand
# directly before the unit's number. Years and months are refused because they
# have no fixed length.
UNITS = (
    ("W", 604800, "P"),
    ("D", 86400, "WP"),
    ("H", 3600, "T"),
    ("M", 60, "HT"),
    ("S", 1, "MHT"),
)

# Nine digits before the point keep whole numbers in the range that a double holds
# exactly; with a fraction, days from about half a million on can be a second short.
# Longer numbers count as malformed.
_NUMBER = r"[0-9]{1,9}+(?:[.,][0-9]{1,9}+)?+"
PATTERN = (
    f"^P(?=[0-9T])(?:{_NUMBER}W)?(?:{_NUMBER}D)?"
    f"(?:T(?:{_NUMBER}H)?(?:{_NUMBER}M)?(?:{_NUMBER}S)?)?\\z"
)

# Half a microsecond. Parts finer than a microsecond are rounded, so a sum that
# is less than this below a whole second is that second.
_ROUNDING = 5e-7


def _unit_seconds(text: Column, unit: str, seconds: int, before: str) -> Column:
    digits = F.substring_index(text, unit, 1)
    for letter in before:
        digits = F.substring_index(digits, letter, -1)
    amount = F.replace(digits, F.lit(","), F.lit(".")).cast("double") * F.lit(float(seconds))
    return F.when(F.contains(text, F.lit(unit)), amount).otherwise(F.lit(0.0))


def duration_seconds(text: Column | str, wrap_days: bool = False) -> Column:
    """Whole seconds of an ISO-8601 duration; NULL for anything that is not one.

    ``wrap_days`` drops whole days (``PT25H`` counts as one hour), for results
    that must equal those of a job which read only the seconds-of-day part.

    There is one branch for numbers with and without a fraction on purpose: the
    generated code of a row with two durations then stays below the size from
    which the JVM no longer compiles a method.
    """
    text = F.col(text) if isinstance(text, str) else text
    total = reduce(add, [_unit_seconds(text, *unit) for unit in UNITS])
    seconds = F.when(text.rlike(PATTERN), F.floor(total + _ROUNDING))
    return F.pmod(seconds, F.lit(86400).cast("bigint")) if wrap_days else seconds


def duration_minutes(text: Column | str, wrap_days: bool = False) -> Column:
    """Whole minutes of an ISO-8601 duration, the rest of a minute dropped."""
    return (duration_seconds(text, wrap_days) / F.lit(60)).cast("bigint")


def duration_problem(text: Column | str) -> Column:
    """``missing``, ``malformed`` or NULL when the text is a duration."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.isNull(), F.lit("missing")).when(
        ~text.rlike(PATTERN), F.lit("malformed")
    )
