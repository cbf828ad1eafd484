"""Tolerant date parsing (P11) with built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions.text import strip

# The accepted layouts, in the order in which they are tried (day first before month first).
# Each layout is tied to the shape of the text, so a row pays for one or two parses and not for thirteen.
SHAPED_LAYOUTS = [
    (r"^\d{4}-\d{1,2}-\d{1,2}$", ["yyyy-M-d"]),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", ["yyyy/M/d"]),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", ["d-M-yyyy"]),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", ["d/M/yyyy", "M/d/yyyy"]),
    (r"^\d{8}$", ["yyyyMMdd"]),
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$", ["yyyy-M-d H:m:s"]),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$", ["yyyy/M/d H:m:s"]),
    (r"^\d{1,2}-\d{1,2}-\d{4} \d{1,2}:\d{1,2}:\d{1,2}$", ["d-M-yyyy H:m:s"]),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}$", ["d/M/yyyy H:m:s"]),
    (r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}$", ["yyyy-M-d'T'H:m:s"]),
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}$", ["yyyy-M-d H:m"]),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{1,2}$", ["yyyy/M/d H:m"]),
]

# Layouts of the free-form tail that have one reading (month first when both readings are valid).
FREE_FORM_LAYOUTS = [
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}(:\d{1,2})?$", ["M/d/yyyy H:m[:s]", "d/M/yyyy H:m[:s]"]),
    (r"^\d{1,2}-\d{1,2}-\d{4} \d{1,2}:\d{1,2}(:\d{1,2})?$", ["M-d-yyyy H:m[:s]", "d-M-yyyy H:m[:s]"]),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", ["M-d-yyyy"]),
    (r"^\d{4}\.\d{1,2}\.\d{1,2}$", ["yyyy.M.d"]),
    (r"^[A-Za-z]{3} \d{1,2},? \d{4}$", ["MMM d, yyyy", "MMM d yyyy"]),
    (r"^[A-Za-z]{4,9} \d{1,2},? \d{4}$", ["MMMM d, yyyy", "MMMM d yyyy"]),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", ["d MMM yyyy"]),
    (r"^\d{1,2} [A-Za-z]{4,9} \d{4}$", ["d MMMM yyyy"]),
]

SERIAL_FIRST, SERIAL_LAST = 1, 2958465  # spreadsheet day numbers, counted from 1899-12-30


def serial_to_timestamp(days: Column) -> Column:
    """Spreadsheet day number (a fraction is the time of day); outside the valid range → NULL."""
    whole = F.floor(days)
    seconds = F.round((days - whole) * 86400, 6)
    moment = F.lit("1899-12-30").cast("timestamp_ntz") + F.make_dt_interval(
        days=whole.cast("int"), secs=seconds.cast("decimal(18,6)")
    )
    return F.when(days.between(SERIAL_FIRST, SERIAL_LAST), moment)


def _first_layout(text: Column, layouts) -> Column:
    tries = [
        F.when(text.rlike(shape), F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in patterns]))
        for shape, patterns in layouts
    ]
    return F.coalesce(*tries).cast("timestamp_ntz")


def clean_date_text(value: Column) -> Column:
    """Trimmed, single blanks, no fraction of a second after a date with a time."""
    text = F.regexp_replace(strip(value.cast("string")), r"(?U)\s+", " ")
    return F.regexp_replace(text, r"^(\d{4}[/-]\d{1,2}[/-]\d{1,2} \d{1,2}:\d{1,2}:\d{1,2})\.\d+", "$1")


def parse_clean_date(text: Column) -> Column:
    """Cleaned text → timestamp. Stage the cleaned text as a column first: it is looked at many times."""
    number = F.when(text.rlike(r"^\d{1,7}(\.\d+)?$"), text.try_cast("double"))
    # The wall clock counts: an offset is dropped, and the session's time zone has no part in it.
    iso = F.when(
        text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:?\d{2})?$"),
        F.regexp_replace(text, r"(Z|[+-]\d{2}:?\d{2})$", "").try_cast("timestamp_ntz"),
    )
    return F.coalesce(
        _first_layout(text, SHAPED_LAYOUTS), iso, _first_layout(text, FREE_FORM_LAYOUTS), serial_to_timestamp(number)
    )


def parse_date(value: Column, dtype: T.DataType | None = None) -> Column:
    """Text, number or date → timestamp without zone; what cannot be read → NULL.

    Order: the fixed layouts, then ISO text with fraction or offset, then the unambiguous free-form layouts, then
    a plain number as a spreadsheet day. Text beyond these is NULL; the loader decides what to do with it.
    """
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return value.cast("timestamp_ntz")
    if isinstance(dtype, T.NumericType):
        return serial_to_timestamp(value.cast("double"))
    return parse_clean_date(clean_date_text(value))


def year_range(date_column: Column, year: int) -> Column:
    """"Year of the date equals" as a range (F04), so that it reaches the Parquet scan and prunes row groups."""
    return (date_column >= F.lit(f"{year:04d}-01-01").cast("timestamp_ntz")) & (
        date_column < F.lit(f"{year + 1:04d}-01-01").cast("timestamp_ntz")
    )
