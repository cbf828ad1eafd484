"""Elapsed times and display timestamps of the execution history."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverlode.functions.text import WHITE_SPACE, strip

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _number(trimmed: Column) -> Column:
    return F.when(trimmed.rlike(NUMBER), trimmed.try_cast("double"))


def format_seconds(seconds: Column) -> Column:
    """Never negative, three decimals; NULL stays NULL."""
    return F.call_function("format_number", F.when(seconds < 0, 0.0).otherwise(seconds), F.lit("0.000"))


def elapsed_seconds(value: Column) -> Column:
    """``12ms``, ``3秒``, ``mm:ss``, ``hh:mm:ss``, ``1,234`` or a number → seconds; other text is kept."""

    def read(text: Column) -> Column:
        unit = F.regexp_extract(text, "(ms|秒)$", 1)
        parts = F.split(F.regexp_replace(text, "(ms|秒)$|,", ""), ":")
        # Most cells hold no white space; only then are the parts trimmed on their own.
        parts = F.when(F.translate(text, WHITE_SPACE, "") == text, parts).otherwise(F.transform(parts, strip))
        total = F.aggregate(parts, F.lit(0.0), lambda acc, part: acc * 60 + _number(part))
        allowed = F.size(parts) <= F.when(unit == "", 3).otherwise(1)
        seconds = F.when(allowed, F.when(unit == "ms", total / 1000).otherwise(total))
        return F.coalesce(format_seconds(seconds), text, F.lit(""))

    return F.element_at(F.transform(F.array(strip(value)), read), 1)


def display_timestamp(value: Column) -> Column:
    """Blank for ``T``, no offset, no fraction; empty → ``-``."""
    spaced = F.replace(value, F.lit("T"), F.lit(" "))
    shown = F.substring_index(F.substring_index(spaced, "+", 1), ".", 1)
    return F.when(F.coalesce(value, F.lit("")) == "", F.lit("-")).otherwise(shown)


def status_message(status: Column) -> Column:
    """Error text of a status line: a leading mark (❌ ⚠️ ⏳ ✅) is one character shorter, as in the history."""
    text = strip(F.coalesce(status, F.lit("")))
    return F.when(text.rlike("^[❌⚠⏳✅]"), strip(F.substring(text, F.lit(2), F.length(text)))).otherwise(text)
