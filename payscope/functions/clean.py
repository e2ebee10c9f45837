"""Casting, suppression and text cleaning expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed by a whitespace trim (plain ``trim`` in Spark
# removes only the space character).
WHITESPACE = " \t\n\r\f\x0b\u00a0"

# Suppression placeholders of the readmission and complication files,
# and of the survey file, which has one more.
PLACEHOLDERS = ("N/A", "Not Available", "")
SURVEY_PLACEHOLDERS = ("Not Applicable", "Not Available", "N/A", "")

# Spellings a text load leaves behind for a missing cell.
MISSING_TEXT = ("nan", "None")


def trimmed(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def missing_to_null(c: Column, spellings: Sequence[str] = MISSING_TEXT) -> Column:
    """A missing cell that was written out as text becomes a real NULL again."""
    return F.when(~c.isin(*spellings), c)


# Only text of these forms is cast. Besides being stricter than the cast, which also
# takes type suffixes (``1d``, ``1f``), hex floats, NaN and infinities, the test is cheap
# where a failed cast is not: it costs an exception per row, and in files like the survey
# nearly nine rows in ten are placeholders.
_INTEGER = r"^[+-]?[0-9]+$"
_DECIMAL = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def safe_int(c: Column) -> Column:
    text = trimmed(c)
    return F.when(text.rlike(_INTEGER), text.try_cast("bigint"))


def safe_double(c: Column) -> Column:
    """Malformed text becomes NULL."""
    text = trimmed(c)
    return F.when(text.rlike(_DECIMAL), text.try_cast("double"))


def safe_date(c: Column, formats: Sequence[str] = ()) -> Column:
    """ISO dates only, so that ``2021`` does not turn into a day; ``formats`` names
    further patterns to try in order, e.g. ``MM/dd/yyyy``."""
    text = trimmed(c)
    iso = F.when(text.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), text.try_cast("date"))
    return F.coalesce(iso, *(F.when(text.rlike("[0-9]"), F.try_to_date(text, f)) for f in formats))


def is_suppressed(c: Column, placeholders: Sequence[str] = PLACEHOLDERS) -> Column:
    """True for NULL or a listed placeholder; never NULL itself."""
    return F.coalesce(trimmed(c).isin(*placeholders), F.lit(True))


def blank_to_null(c: Column) -> Column:
    return F.nullif(trimmed(c), F.lit(""))


def classify_prefix(
    c: Column, length: int, classes: Mapping[str, Sequence[str]], otherwise: str
) -> Column:
    """Bucket by the first ``length`` characters; NULL and unlisted go to ``otherwise``."""
    prefix = F.substring(c, 1, length)
    label = F.lit(otherwise)
    for name, prefixes in reversed(classes.items()):
        label = F.when(prefix.isin(*prefixes), F.lit(name)).otherwise(label)
    return label


def any_present(*columns: Column) -> Column:
    """At least one of the columns is not NULL, whatever their types."""
    found = columns[0].isNotNull()
    for c in columns[1:]:
        found = found | c.isNotNull()
    return found


def first_of(array: Column) -> Column:
    """First element of an array; NULL for a NULL or empty one."""
    return F.get(array, F.lit(0))


def reliable(volume: Column, flag: Column, minimum: int) -> Column:
    """``volume >= minimum AND flag`` in three-valued logic: an unknown flag stays
    unknown unless the volume already fails."""
    return (volume >= F.lit(minimum)) & flag
