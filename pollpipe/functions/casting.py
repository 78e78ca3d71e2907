"""Strict casts from JSON text to typed columns.

Every cast takes the value as text and its JSON kind: ``string``, ``number``,
``boolean``, ``object`` or ``array``; a JSON null or an absent key has a NULL
kind. A value that cannot be cast becomes NULL and is reported by
:func:`cast_failed`; a NULL in is a NULL out and no failure.

Rules that a bare Spark cast would get wrong:

* a string never becomes a boolean, a non-string never becomes a string;
* a JSON boolean counts as 1 or 0 for numbers;
* text is cut to an integer only if it is an integer (``"12.9"`` fails), a JSON
  number is truncated (``12.9`` gives 12);
* NaN and infinities are failures, so they never reach a comparison;
* text such as ``1.5d``, ``2026`` or ``12:00:00``, which Spark would accept, is
  refused by a pattern before the cast.

Digits may be grouped (``1_000``), and dates and times may be in the basic or the week
form (``20260918T0800``, ``2026-W38-5``). Times without an offset are read as UTC, so the
session time zone has to be UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..spec import SPARK_TYPES

_DIGITS = r"\d+(_\d+)*"
FLOAT_TEXT = rf"^\s*[+-]?({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?\s*$"
INT_TEXT = rf"^\s*[+-]?{_DIGITS}\s*$"
ISO_TEXT = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2}(:?\d{2})?)?)?)?$"
)
# Texts of that form that are no day or no hour. A failing cast raises and catches an error, which
# costs far more than this pattern; days that only some years have are left to the cast.
NO_TIME = r"^\d{4}-(00|1[3-9]|[2-9]\d|\d{2}-(00|3[2-9]|[4-9]\d)|02-3[01]|(0[469]|11)-31|\d{2}-\d{2}[T ](2[4-9]|[3-9]\d))"
# The other forms of a date, and of a time behind any date.
OTHER_DATE = r"^(\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-W\d{2}(?:-[1-7])?|\d{4}W\d{2}[1-7]?)"
OTHER_ISO_TEXT = (
    OTHER_DATE + r"([T ](\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?|\d{4}(\d{2}([.,]\d+)?)?)(Z|[+-]\d{2}(:?\d{2}(:?\d{2})?)?)?)?$"
)


# First two letters of a variant's schema text, per kind
_KINDS = {
    "ST": "string", "BO": "boolean", "OB": "object", "AR": "array",
    "BI": "number", "DE": "number", "DO": "number", "FL": "number",
}


def json_kind(value: Column) -> Column:
    """Kind of a VARIANT value; NULL for JSON null and for an absent key."""
    kinds = F.create_map(*[F.lit(part) for pair in _KINDS.items() for part in pair])
    return F.try_element_at(kinds, F.left(F.schema_of_variant(value), F.lit(2)))


def json_text(value: Column) -> Column:
    """Text of a VARIANT value: strings without quotes, objects and arrays as JSON."""
    return F.try_variant_get(value, "$", "string")


def finite(value: Column) -> Column:
    # NaN sorts above infinity in Spark, so one comparison rejects both
    return F.when(F.abs(value) < float("inf"), value)


def _ungrouped(text: Column) -> Column:
    return F.replace(F.trim(text), F.lit("_"), F.lit(""))


def _extended(text: Column) -> Column:
    """A text of :data:`OTHER_ISO_TEXT` with date and time in the form with separators; NULL for
    a week that its year does not have."""
    date = F.regexp_extract(text, OTHER_DATE, 1)
    digits = F.regexp_replace(date, "[-W]", "")
    year, week = F.left(digits, F.lit(4)).try_cast("int"), F.substring(digits, 5, 2).try_cast("int")
    day = F.coalesce(F.nullif(F.substring(digits, 7, 1), F.lit("")).try_cast("int"), F.lit(1))
    fourth = F.try_to_date(F.concat(F.left(digits, F.lit(4)), F.lit("-01-04")))
    of_week = F.date_add(fourth, (week - 1) * 7 + day - 1 - F.weekday(fourth))
    of_week = F.when(F.weekofyear(of_week) == week, of_week.cast("string"))
    basic = F.concat_ws("-", F.left(digits, F.lit(4)), F.substring(digits, 5, 2), F.substring(digits, 7, 2))
    time = F.substring(text, F.char_length(date) + 1, F.char_length(text))
    seconds = F.when(time.rlike(r"^[T ]\d{6}"), F.lit(":")).otherwise("")
    spread = F.concat(F.left(time, F.lit(3)), F.lit(":"), F.substring(time, 4, 2), seconds, F.substring(time, F.lit(6), F.char_length(time)))
    return F.concat(
        F.when(date.contains("W"), of_week).otherwise(basic), F.when(time.rlike(r"^[T ]\d{4}"), spread).otherwise(time)
    )


def _to_float(text: Column, kind: Column) -> Column:
    # JSON numbers have neither blanks nor grouped digits
    number = (
        F.when(kind == "number", text.try_cast("double"))
        .when(kind == "boolean", (text == "true").cast("double"))
        .when((kind == "string") & text.rlike(FLOAT_TEXT), _ungrouped(text).try_cast("double"))
    )
    return finite(number)


def _to_int(text: Column, kind: Column) -> Column:
    # casts that are bound to fail are not tried, as each would raise and catch an error
    whole = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))
    number = text.try_cast("double")
    cut = F.when(F.abs(number) <= 2.0**63, number.try_cast("bigint"))
    return (
        F.when(kind == "number", F.coalesce(whole, cut))
        .when(kind == "boolean", (text == "true").cast("bigint"))
        .when((kind == "string") & text.rlike(INT_TEXT), _ungrouped(text).try_cast("bigint"))
    )


def _to_time(text: Column, kind: Column) -> Column:
    instant = lambda t: F.replace(t, F.lit(","), F.lit(".")).try_cast("timestamp")
    # The rare forms are put as a function over an array of one text: its body stays out of the
    # generated code, which could not hold it once per field, and runs only for texts not in the usual form.
    rare = F.transform(F.array(text), lambda t: F.when(t.rlike(OTHER_ISO_TEXT), _extended(t)))[0]
    usual = F.when(~text.rlike(NO_TIME), text)
    return F.when(kind == "string", instant(F.when(text.rlike(ISO_TEXT), usual).otherwise(rare)))


def _to_bool(text: Column, kind: Column) -> Column:
    return F.when(kind == "boolean", text == "true")


def _to_str(text: Column, kind: Column) -> Column:
    return F.when(kind == "string", text)


_CASTS = {"float": _to_float, "int": _to_int, "datetime": _to_time, "bool": _to_bool, "str": _to_str}


def cast_value(text: Column, type_name: str, kind: Column | None = None) -> Column:
    """``text`` as ``type_name``; NULL where it does not fit. ``kind`` defaults to string."""
    if type_name not in _CASTS:
        raise ValueError(f"unknown type {type_name!r}, use one of {sorted(SPARK_TYPES)}")
    if kind is None:
        kind = F.when(text.isNotNull(), "string")
    return _CASTS[type_name](text, kind)


def cast_failed(text: Column, type_name: str, kind: Column | None = None) -> Column:
    """True where a value is present and cannot be cast. Never NULL."""
    present = text.isNotNull() if kind is None else kind.isNotNull()
    return present & cast_value(text, type_name, kind).isNull()
