"""Value coercion into the target types: a value that does not parse becomes NULL, never an error.

All text grammars are culture-invariant and independent of the session time zone. Values pass a
pattern first and are cast with ``try_cast`` afterwards, so ANSI mode cannot abort a job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Number text may carry thousands separators, one sign or parentheses, the generic
# currency sign, an exponent and outer blanks; a decimal holds at most DECIMAL_MAX in magnitude.
_BODY = r"(?:[0-9][0-9,]*(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][-+]?[0-9]+)?"
NUMBER_PATTERN = (
    rf"^\s*(?:[-+]?¤?{_BODY}|¤[-+]?{_BODY}|\(¤?{_BODY}\s*\)|¤?{_BODY}\s*[-+])\s*¤?\s*$"
)
INTEGER_PATTERN = r"^\s*[-+]?[0-9]+\s*$"
DATETIME_PATTERN = r"^\s*[0-9]{4}([-/])[0-9]{2}\1[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?\s*$"
DECIMAL_MAX = 7.9228162514264338e28
DECIMAL_STEP = 1e-28


def _parsed_number(raw: Column) -> Column:
    bare = F.regexp_replace(raw, r"[\s¤,()]", "")
    magnitude = F.regexp_replace(bare, "^[-+]|[-+]$", "").try_cast("double")
    negative = raw.rlike(r"^[\s¤]*[-(]|-[\s¤]*$")
    return F.when(raw.rlike(NUMBER_PATTERN), F.when(negative, -magnitude).otherwise(magnitude))


def to_double(raw: Column) -> Column:
    """Number text as double; also the spelled-out NaN and infinities."""
    word = F.lower(F.trim(raw))
    return (
        F.when(word.rlike(r"^[-+]?nan$"), F.lit(float("nan")))
        .when(word.rlike(r"^[+]?infinity$"), F.lit(float("inf")))
        .when(word == "-infinity", F.lit(float("-inf")))
        .otherwise(_parsed_number(raw))
    )


def to_decimal(raw: Column) -> Column:
    """Same grammar limited to the decimal range; the target stores it as double."""
    number = _parsed_number(raw)
    return F.when(F.abs(number) < DECIMAL_STEP / 2, F.lit(0.0)).when(F.abs(number) <= DECIMAL_MAX, number)


def to_integer(raw: Column) -> Column:
    """Whole-number text as bigint; fractions and overflow give NULL."""
    return F.when(raw.rlike(INTEGER_PATTERN), F.regexp_replace(raw, r"\s", "").try_cast("bigint"))


def to_datetime(raw: Column) -> Column:
    """ISO date or date-time text, ``-`` or ``/`` between date parts, as timestamp without zone."""
    iso = F.regexp_replace(F.regexp_replace(raw, r"^\s+|\s+$", ""), "/", "-")
    return F.when(raw.rlike(DATETIME_PATTERN), iso.try_cast("timestamp_ntz"))


def to_boolean(raw: Column) -> Column:
    """``true`` or ``false`` in any case; nothing else."""
    return F.when(raw.rlike(r"(?i)^\s*true\s*$"), True).when(raw.rlike(r"(?i)^\s*false\s*$"), False)


def to_text(value: Column, data_type: T.DataType) -> Column:
    """Any value as text; nested values as JSON."""
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(value)
    return value.cast("string")


# How text is read for each target type of the profile.
FROM_TEXT = {
    "DOUBLE": to_double,
    "LONG": to_integer,
    "SHORT": to_integer,
    "DATETIME": to_datetime,
    "YESNO": to_boolean,
}
