"""Date and time expressions. Results are ``timestamp_ntz`` in UTC, whatever the session zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# The accepted text forms. A date alone, or date 'T' time with an
# optional fraction of 1-6 digits and an optional offset (Z, +HHMM or +HH:MM,
# seconds allowed). Hours, minutes and seconds may have one digit.
_DATE = r"(?!0000)\d{4}-(?:1[0-2]|0[1-9]|[1-9])-(?:3[01]|[12]\d|0[1-9]| ?[1-9])"
_TIME = r"(?:2[0-3]|[01]\d|\d):(?:[0-5]\d|\d):(?:[0-5]\d|\d)(?:\.\d{1,6})?"
_OFFSET = (
    r"[+-](?:2[0-3]|[01]\d)"
    r"(?::[0-5]\d(?::[0-5]\d(?:\.\d{1,6})?)?|[0-5]\d(?:[0-5]\d(?:\.\d{1,6})?)?)"
)
DATE_TEXT = rf"^{_DATE}(?:[Tt]{_TIME}(?:Z|{_OFFSET})?)?\z"


def safe_parse_date_sql(text: str) -> str:
    """SQL of :func:`safe_parse_date` over a SQL expression; wide tables build many of these."""
    offset = f"regexp_extract({text}, r'[Tt].*?({_OFFSET})\\z', 1)"
    digits = f"replace({offset}, ':', '')"

    def part(start: int, length: int, kind: str) -> str:
        signed = f"concat(left({offset}, 1), substring({digits}, {start}, {length}))"
        return f"coalesce(try_cast({signed} AS {kind}), 0)"

    def wall(part: str) -> str:
        return f"try_cast(translate({part}, 't ', 'T0') AS timestamp_ntz)"

    bare = f"left({text}, length({text}) - length({offset}))"
    shift = f"make_dt_interval(0, {part(2, 2, 'int')}, {part(4, 2, 'int')}, {part(6, 9, 'decimal(18,6)')})"
    return (
        f"CASE WHEN rlike({text}, r'{DATE_TEXT}') THEN "
        f"CASE WHEN endswith({text}, 'Z') OR endswith({text}, '+0000') OR {offset} = '' "
        f"THEN {wall(text)} ELSE {wall(bare)} - {shift} END END"
    )


def safe_parse_date(text: str) -> Column:
    """Strictly parse a date text (a column name or SQL expression) to naive UTC; else NULL.

    One anchored pattern decides what is accepted, so that the lenient cast
    behind it never sees a form it should not take. An offset is cut off before
    the cast and then subtracted.
    """
    return F.expr(safe_parse_date_sql(text))


def instant_sql(column: str, data_type: T.DataType) -> str:
    """Any date-like column as naive UTC; other types are NULL."""
    if isinstance(data_type, T.StringType):
        return safe_parse_date_sql(column)
    if isinstance(data_type, (T.TimestampNTZType, T.DateType)):
        return f"CAST({column} AS timestamp_ntz)"
    if isinstance(data_type, T.TimestampType):
        seconds = f"CAST(CAST(unix_micros({column}) AS decimal(24,0)) / 1000000 AS decimal(18,6))"
        return f"timestamp_ntz'1970-01-01' + make_dt_interval(0, 0, 0, {seconds})"
    return "CAST(NULL AS timestamp_ntz)"


def instant(column: str, data_type: T.DataType) -> Column:
    return F.expr(instant_sql(column, data_type))


def to_millis(ts: Column) -> Column:
    """A watermark as the remote side sees it: cut to milliseconds."""
    beyond = F.date_part(F.lit("SECOND"), ts) % F.lit("0.001").cast("decimal(4,3)")
    zero = F.lit(0)
    return ts - F.make_dt_interval(zero, zero, zero, beyond.cast("decimal(18,6)"))


# A cast to text renders the wall clock as it is; date_format would go through
# the session zone first and move times that fall into a gap there.
def _wall_parts(ts: Column) -> tuple[Column, Column]:
    text = ts.cast("timestamp_ntz").cast("string")
    return F.translate(F.substring(text, 1, 19), " ", "T"), F.substring(text, 21, 6)


def watermark_text(ts: Column) -> Column:
    """``2024-01-15T10:30:00.123Z``, cut to milliseconds."""
    seconds, fraction = _wall_parts(ts)
    return F.concat(seconds, F.lit("."), F.rpad(F.substring(fraction, 1, 3), 3, "0"), F.lit("Z"))


def iso_text(ts: Column) -> Column:
    """ISO text with six fraction digits where there are any, else none."""
    seconds, fraction = _wall_parts(ts)
    return F.when(fraction == "", seconds).otherwise(
        F.concat(seconds, F.lit("."), F.rpad(fraction, 6, "0"))
    )
