"""Column expressions: conditionals, text, dates.  Everything stays in codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def if_else(cond: Column, yes, no) -> Column:
    """Conditional that is NULL when the condition is NULL."""
    return F.when(cond, yes).when(~cond, no)


def case_when(*arms, default=None) -> Column:
    """Arms (condition, value) in order; a NULL condition does not match."""
    out = F
    for cond, value in arms:
        out = out.when(cond, value)
    return out.otherwise(default)


def is_in(col: Column, values) -> Column:
    """Set membership that is never NULL."""
    return F.coalesce(col.isin(*values), F.lit(False))


def level_position(col: Column, levels: list) -> Column:
    """1-based position in an ordered level list; NULL outside the list."""
    return F.nullif(F.array_position(F.array(*map(F.lit, levels)), col), F.lit(0)).cast("int")


def relabel(col: Column, levels: list, labels: list) -> Column:
    return case_when(*[(col == lv, F.lit(lb)) for lv, lb in zip(levels, labels)])


def celsius_to_fahrenheit(c: Column) -> Column:
    return c * 9.0 / 5.0 + 32.0


# ── text ─────────────────────────────────────────────────────────────────────

def str_replace_first(col: Column, pattern: str, to: str) -> Column:
    return F.regexp_replace(col, f"(?s)^(.*?)(?:{pattern})", f"$1{to}")


def str_starts(col: Column, pattern: str) -> Column:
    return col.rlike(f"^(?:{pattern})")


def str_ends(col: Column, pattern: str) -> Column:
    return col.rlike(f"(?:{pattern})$")


def str_squish(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, r"\s+", " "))


def str_title(col: Column) -> Column:
    return F.initcap(F.lower(col))


def str_pad(col: Column, width: int, pad: str = " ") -> Column:
    """Left-pad to width; longer input is kept whole."""
    return F.when(F.char_length(col) >= width, col).otherwise(F.lpad(col, width, pad))


def percent_label(share: Column, digits: int = 1) -> Column:
    return F.format_string(f"%.{digits}f%%", share)


def dollar_label(x: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(x, 0))


# ── dates ────────────────────────────────────────────────────────────────────

def week_of_year(ts: Column) -> Column:
    """Complete seven-day periods since 1 January, plus one."""
    return (F.floor((F.dayofyear(ts) - 1) / 7) + 1).cast("int")


def weekday_monday1(ts: Column) -> Column:
    return F.weekday(ts) + 1


def quarter_label(month: Column) -> Column:
    return F.concat(F.lit("Q"), F.ceil(month / 3).cast("string"))


def cyclical(value: Column, period: int) -> tuple[Column, Column]:
    angle = value * (2.0 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def date_features(ts: Column, peak_hours: list[int] = (), holiday_months: list[int] = ()) -> dict[str, Column]:
    """Calendar parts, flags and circular encodings of a date-time.  Which hours are busy
    and which months hold holidays depends on the data, so the caller says."""
    hour, month = F.hour(ts), F.month(ts)
    hour_sin, hour_cos = cyclical(hour, 24)
    month_sin, month_cos = cyclical(month, 12)
    return {
        "year": F.year(ts),
        "month": month,
        "month_name": F.date_format(ts, "MMM"),
        "day_of_month": F.dayofmonth(ts),
        "day_of_week": F.date_format(ts, "E"),
        "week_of_year": week_of_year(ts),
        "quarter": F.quarter(ts),
        "hour_of_day": hour,
        "is_weekend": is_in(weekday_monday1(ts), [6, 7]),
        "is_peak_hour": is_in(hour, list(peak_hours)),
        "is_holiday_month": is_in(month, list(holiday_months)),
        "hour_sin": hour_sin,
        "hour_cos": hour_cos,
        "month_sin": month_sin,
        "month_cos": month_cos,
    }
