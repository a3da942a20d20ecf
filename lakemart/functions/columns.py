"""Scalar and aggregate helpers.

Each helper takes SQL expressions (usually column names) and writes one SQL expression made of
built-in functions, so the work stays inside generated JVM code. Calling it gives a Column;
``helper.sql(...)`` gives the text, for use in ``selectExpr`` or inside another helper.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import Column
from pyspark.sql import functions as F

# They decide the surrogate keys, so they must not change between runs.
NULL_KEY_TEXT = "_dbt_null_"
UNKNOWN_KEY = -1
KEY_HEX_DIGITS = 15

MONEY = "decimal(12,2)"
ORDER_MONEY = "decimal(14,2)"
MART_MONEY = "decimal(16,2)"
RATE = "decimal(8,4)"
DURATION = "decimal(20,6)"

NUMBER_SHAPE = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"


def sql_helper(build: Callable[..., str]) -> Callable[..., Column]:
    @wraps(build)
    def column(*args, **kwargs) -> Column:
        return F.expr(build(*args, **kwargs))

    column.sql = build
    return column


def literal(value: object) -> str:
    """SQL literal of a text or number."""
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return str(value)


# ---- text -----------------------------------------------------------------------------


@sql_helper
def identifier(c: str) -> str:
    """Text key without surrounding spaces (an empty key stays empty)."""
    return f"trim({c})"


@sql_helper
def code(c: str) -> str:
    """Lower-case code without surrounding spaces."""
    return f"lower(trim({c}))"


@sql_helper
def blank_to_null(c: str) -> str:
    """Trimmed text, with a blank value turned into null."""
    return f"nullif(trim({c}), '')"


@sql_helper
def strict_cast(c: str, data_type: str) -> str:
    """Typed value of a text column; empty is null and any other bad value aborts (ANSI)."""
    return f"cast(nullif({c}, '') as {data_type})"


@sql_helper
def is_blank(c: str) -> str:
    """Null, empty or only whitespace of any kind, as Unicode and its separators have it."""
    return f"coalesce({c} rlike r'(?U)^[\\s\\x1c-\\x1f]*$', true)"


@sql_helper
def parsed_number(c: str) -> str:
    """Number in a text, or null when the text is not one.

    Spark would read ``1d`` and ``1f`` as numbers, so the shape is tested first.
    """
    return f"if(trim({c}) rlike r'{NUMBER_SHAPE}', try_cast(trim({c}) as double), null)"


@sql_helper
def unaccepted(c: str, accepted: Sequence[str]) -> str:
    """True for a value outside the list; null is accepted."""
    return f"coalesce({c} not in ({', '.join(map(literal, accepted))}), false)"


# ---- keys -----------------------------------------------------------------------------


@sql_helper
def composite_text(*parts: str) -> str:
    """Parts joined by ``|``; null as soon as one part is null."""
    return "concat(" + ", '|', ".join(f"cast({part} as string)" for part in parts) + ")"


@sql_helper
def stable_key(*parts: str) -> str:
    """Run-independent 60-bit surrogate key: the leading hex digits of an MD5 as a bigint.

    The key is never null. The outer coalesce says so to the optimizer, which would otherwise
    put a null test, and with it a second digest, in front of every join on the key.
    """
    text = composite_text.sql(*parts) if len(parts) > 1 else f"cast({parts[0]} as string)"
    digits = f"left(md5(coalesce({text}, '{NULL_KEY_TEXT}')), {KEY_HEX_DIGITS})"
    return f"coalesce(cast(conv({digits}, 16, 10) as bigint), 0L)"


# ---- time -----------------------------------------------------------------------------


@sql_helper
def newest(*columns: str) -> str:
    """Latest of several times, ignoring nulls."""
    return f"greatest({', '.join(columns)})"


@sql_helper
def date_key(c: str) -> str:
    """``yyyymmdd`` as an integer. Integer arithmetic: no formatter and no session zone."""
    return f"year({c}) * 10000 + month({c}) * 100 + day({c})"


@sql_helper
def elapsed(start: str, end: str, unit_seconds: int, data_type: str = DURATION) -> str:
    """Signed fractional time from ``start`` to ``end`` in units of ``unit_seconds``.

    The difference is taken as an interval, which for zone-less times needs no session zone.
    """
    seconds = f"cast(cast({end} - {start} as interval second) as {DURATION})"
    return f"cast({seconds} / {unit_seconds} as {data_type})"


@sql_helper
def late_flag(delivered: str, estimated: str) -> str:
    """Null while undelivered or without an estimate, else whether delivery came after it."""
    return f"if({delivered} is not null, {delivered} > {estimated}, null)"


def calendar_columns(day: str) -> list[str]:
    """Calendar attributes of a date. Weekdays and weeks are ISO (Monday is 1)."""
    small = {
        "day_of_month": f"day({day})",
        "day_of_week": f"weekday({day}) + 1",
        "week_of_year": f"weekofyear({day})",
        "month_number": f"month({day})",
        "quarter_number": f"quarter({day})",
        "year_number": f"year({day})",
    }
    columns = {name: f"cast({value} as smallint)" for name, value in small.items()}
    columns["date_key"] = date_key.sql(day)
    columns["full_date"] = day
    columns["day_name"] = f"date_format({day}, 'EEEE')"
    columns["month_name"] = f"date_format({day}, 'MMMM')"
    columns["is_weekend"] = f"weekday({day}) >= 5"
    return [f"{columns[name]} as {name}" for name in CALENDAR_ORDER]


CALENDAR_ORDER = (
    "date_key",
    "full_date",
    "day_of_month",
    "day_of_week",
    "day_name",
    "week_of_year",
    "month_number",
    "month_name",
    "quarter_number",
    "year_number",
    "is_weekend",
)


# ---- exact arithmetic -----------------------------------------------------------------


@sql_helper
def total(c: str, data_type: str = MART_MONEY) -> str:
    """Exact decimal sum."""
    return f"cast(sum({c}) as {data_type})"


@sql_helper
def quotient(numerator: str, denominator: str, data_type: str) -> str:
    """``numerator / denominator`` in exact decimals, null for a zero denominator.

    Two bigints would divide as doubles, so a count has to become a decimal first. The
    inner quotient keeps 16 or more decimals, so the one visible rounding is the last cast.
    """
    safe = f"nullif(cast({denominator} as decimal(20,0)), cast(0 as decimal(20,0)))"
    return f"cast(({numerator}) / {safe} as {data_type})"


@sql_helper
def rate(part: str, whole: str, data_type: str = RATE) -> str:
    return quotient.sql(f"cast({part} as decimal(20,0))", whole, data_type)


@sql_helper
def mean_money(c: str, data_type: str = MART_MONEY) -> str:
    """Average as sum over count, so that it is rounded once."""
    return quotient.sql(f"sum({c})", f"count({c})", data_type)


@sql_helper
def exact_mean(c: str) -> str:
    """Average of decimals as a double; the sum is exact, so task order cannot change it."""
    return f"cast(sum({c}) as double) / nullif(count({c}), 0)"
