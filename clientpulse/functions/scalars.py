"""Scalar expressions. Every function maps columns to a column; none needs Python at run time."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# A plain decimal number, and the zone suffix of an ISO-8601 timestamp.
DECIMAL_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
ZONE_SUFFIX = r"(T.*?)(Z|[+-]\d{2}:?\d{2})$"
ISO_START = r"^\d{4}-\d{2}-\d{2}"


def col_of(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- numbers ---------------------------------------------------------------------------------


def round_half_up(c: ColumnOrName, scale: int = 2) -> Column:
    """The rule of SQL engines: halves away from zero, on the decimal text of the double."""
    return F.round(col_of(c), scale)


def round_half_even(c: ColumnOrName, scale: int = 2) -> Column:
    """The rule of array libraries: scale up, round halves to even, scale down."""
    power = F.lit(float(10 ** scale))
    return F.rint(col_of(c) * power) / power


def round_exact(c: ColumnOrName, scale: int = 2) -> Column:
    """The rule of Python's ``round``: the nearest decimal to the stored binary value, halves to even."""
    return F.regexp_replace(F.format_number(col_of(c), scale), ",", "").cast("double") + F.lit(0.0)


Rounding = Callable[[Column, int], Column]


def ratio(num: ColumnOrName, den: ColumnOrName, factor: float = 1.0, scale: int | None = None,
          missing: float | None = None, rounding: Rounding = round_half_up) -> Column:
    """``num * factor / den`` in doubles; ``missing`` where the denominator is not positive."""
    top, bottom = col_of(num).cast("double"), col_of(den).cast("double")
    value = top * F.lit(float(factor)) / bottom
    if scale is not None:
        value = rounding(value, scale)
    return F.when(bottom > 0, value).otherwise(F.lit(missing).cast("double"))


def percent(num: ColumnOrName, den: ColumnOrName, scale: int | None = 2, missing: float | None = None,
            rounding: Rounding = round_half_up) -> Column:
    return ratio(num, den, 100.0, scale, missing, rounding)


def change_percent(current: ColumnOrName, previous: ColumnOrName, scale: int | None = 2,
                   missing: float | None = None) -> Column:
    """Growth of ``current`` over ``previous`` in percent."""
    now, before = col_of(current).cast("double"), col_of(previous).cast("double")
    return percent(now - before, before, scale, missing)


def to_double(c: ColumnOrName) -> Column:
    """Double, NULL when the text is not a number."""
    return col_of(c).try_cast("double")


def to_long(c: ColumnOrName) -> Column:
    return col_of(c).try_cast("bigint")


def to_date(c: ColumnOrName) -> Column:
    return col_of(c).try_cast("date")


def safe_float(c: ColumnOrName, default: float | None = 0.0) -> Column:
    """Text to double, ``default`` (None: NULL) for empty, missing or malformed text."""
    text = col_of(c).cast("string")
    parsed = F.when(text.rlike(DECIMAL_TEXT), text.try_cast("double"))
    return parsed if default is None else F.coalesce(parsed, F.lit(float(default)))


def safe_int(c: ColumnOrName, default: int = 0) -> Column:
    """Text to bigint through double, truncating toward zero."""
    text = col_of(c).cast("string")
    parsed = F.when(text.rlike(DECIMAL_TEXT), text.try_cast("double")).try_cast("bigint")
    return F.coalesce(parsed, F.lit(default).cast("bigint"))


def truthy(c: ColumnOrName) -> Column:
    """True for ``true`` and ``1`` in any case or type, false for everything else and NULL."""
    return F.coalesce(F.lower(col_of(c).cast("string")).isin("true", "1"), F.lit(False))


# --- dates -----------------------------------------------------------------------------------


def iso_timestamp(c: ColumnOrName) -> Column:
    """ISO-8601 text to a zone-less timestamp keeping the written clock fields; NULL if malformed."""
    text = col_of(c)
    return F.when(text.rlike(ISO_START), F.regexp_replace(text, ZONE_SUFFIX, "$1").try_cast("timestamp_ntz"))


def epoch_or_iso_date(c: ColumnOrName) -> Column:
    """Date from epoch milliseconds or from the first ten characters of an ISO timestamp."""
    text = col_of(c).cast("string")
    millis = text.try_cast("bigint")
    return F.when(text.contains("T"), F.substring(text, 1, 10).try_cast("date")).otherwise(
        F.date_from_unix_date(F.floor(millis / F.lit(86_400_000)).try_cast("int")))


def days_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Whole calendar days between two dates or timestamps."""
    return F.date_diff(col_of(later).cast("date"), col_of(earlier).cast("date"))


def elapsed_days(until: date, since: ColumnOrName) -> Column:
    """Whole 24-hour days from a timestamp to midnight of ``until``, rounded down."""
    start = col_of(since).cast("timestamp_ntz")
    end = F.lit(until).cast("timestamp_ntz")
    return F.floor(F.timestamp_diff("MICROSECOND", start, end) / F.lit(86_400_000_000.0)).cast("int")


def add_years(c: ColumnOrName, years: int = 1) -> Column:
    return F.add_months(col_of(c).cast("date"), 12 * years)


def month_start(c: ColumnOrName) -> Column:
    return F.trunc(col_of(c).cast("date"), "MM")


def month_end(c: ColumnOrName) -> Column:
    return F.last_day(col_of(c).cast("date"))


def week_start(c: ColumnOrName) -> Column:
    """Monday of the week."""
    return F.trunc(col_of(c).cast("date"), "WEEK")


def year_month(c: ColumnOrName) -> Column:
    return F.date_format(col_of(c).cast("date"), "yyyy-MM")


def previous_year_month(c: ColumnOrName) -> Column:
    return F.date_format(F.add_months(col_of(c).cast("date"), -1), "yyyy-MM")


# --- text and collections --------------------------------------------------------------------


def person_name(first: ColumnOrName, last: ColumnOrName, blank_as_null: bool = True) -> Column:
    """First and last name joined by one space. A blank result is NULL so that fallbacks go on."""
    joined = F.trim(F.concat(F.coalesce(col_of(first), F.lit("")), F.lit(" "), F.coalesce(col_of(last), F.lit(""))))
    return F.nullif(joined, F.lit("")) if blank_as_null else joined


def trimmed(c: ColumnOrName) -> Column:
    """Without surrounding white space of any kind, no-break spaces included."""
    return F.regexp_replace(col_of(c), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def slug(c: ColumnOrName) -> Column:
    """Lower case without surrounding white space of any kind."""
    return trimmed(F.lower(col_of(c)))


def text_part(c: ColumnOrName, separator: str, part: int) -> Column:
    return F.split_part(col_of(c), F.lit(separator), F.lit(part))


def matches_ci(c: ColumnOrName, pattern: str, literal: bool = False) -> Column:
    """Case-insensitive search; a regular expression unless ``literal``. NULL matches nothing."""
    text = col_of(c)
    found = F.lower(text).contains(pattern.lower()) if literal else text.rlike(f"(?i){pattern}")
    return F.coalesce(found, F.lit(False))


def item_count(c: ColumnOrName) -> Column:
    return F.coalesce(F.size(col_of(c)), F.lit(0))


def first_item(c: ColumnOrName) -> Column:
    return F.try_element_at(col_of(c), F.lit(1))


def lookup(c: ColumnOrName, values: Mapping[str, object], default: object = None) -> Column:
    """Value of a small fixed mapping."""
    key = col_of(c)
    out = None
    for name, value in values.items():
        out = F.when(key == name, F.lit(value)) if out is None else out.when(key == name, F.lit(value))
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def band(c: ColumnOrName, steps: list[tuple[float, str]], below: str | None) -> Column:
    """First label whose minimum is reached, ``below`` otherwise; NULL input gives ``below``."""
    value = col_of(c)
    out = None
    for minimum, label in steps:
        out = F.when(value >= minimum, label) if out is None else out.when(value >= minimum, label)
    return out.otherwise(F.lit(below))


def money_text(c: ColumnOrName, scale: int = 2, symbol: str = "R$ ") -> Column:
    return F.concat(F.lit(symbol), F.format_number(F.coalesce(col_of(c), F.lit(0.0)), scale))


def percent_text(c: ColumnOrName, scale: int = 0) -> Column:
    return F.concat(F.format_number(col_of(c), scale), F.lit("%"))
