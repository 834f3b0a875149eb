"""Text to typed value, or NULL where the text is not acceptable.

Each parser is one built-in expression. A NULL result is the failed check, so a
row is validated and typed in the same pass. Departures from a parser that would
abort the run: NULL text and text beyond the column's range are plain failures.
Digit grouping (``1_000``), non-ASCII digits and doubled blanks inside a timestamp
are not accepted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewise.schemas import DATE, DOUBLE, INTEGER, TIMESTAMP, Field

# The accepted shapes. Anchored with \A and \z because a bare $ also
# matches before a trailing line break. Year 0000 does not exist.
_NUMBER = r"\A\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z"
_INFINITY = r"(?i)\A\s*[+-]?inf(inity)?\s*\z"
_NAN = r"(?i)\A\s*[+-]?nan\s*\z"
_DATE = r"\A(?!0000)\d{4}-\d{1,2}-\d{1,2}\z"
_TIMESTAMP = r"\A(?!0000)\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?\z"


def parse_integer(text: Column, to: T.DataType | str = "bigint") -> Column:
    """Signed decimal digits, blanks around them allowed; NULL beyond the type's range."""
    return text.try_cast(to)


def parse_double(text: Column) -> Column:
    """Decimal or exponent form, infinities and nan; Java's ``1.5d`` is refused."""
    return F.when(
        text.rlike(_NUMBER) | text.rlike(_INFINITY), text.try_cast("double")
    ).when(text.rlike(_NAN), F.lit(float("nan")))


def parse_date(text: Column) -> Column:
    """Year-month-day and nothing else; the guard closes the lenient cast."""
    return F.when(text.rlike(_DATE), text.try_cast("date"))


def parse_timestamp(text: Column) -> Column:
    """Date, one blank, time to the second, optional fraction of 1 to 6 digits."""
    return F.when(text.rlike(_TIMESTAMP), text.try_cast("timestamp_ntz"))


def parse_field(field: Field) -> Column:
    """The typed value of one declared column; text passes through unchecked."""
    text = F.col(field.name)
    if field.rule == INTEGER:
        return parse_integer(text, field.type)
    if field.rule == DOUBLE:
        return parse_double(text)
    if field.rule == DATE:
        return parse_date(text)
    if field.rule == TIMESTAMP:
        return parse_timestamp(text)
    return text
