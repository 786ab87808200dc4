"""The single home of type coercion.

Raw monthly exports arrive as text. Every operator coerces the columns it
uses through these helpers, so that junk never raises under ANSI mode:

* numbers: a regex guard, then ``try_cast``; NaN and infinities become null, so
  ``'1d'``, ``'$5'``, ``'NaN'`` and ``'1e400'`` are all null.
* dates / timestamps: whole ISO text (a pattern guards against trailing junk), and
  text in the ``formats`` the caller names; anything else is null.
* flags: a predicate on missing data is 0, never null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the text shape accepted as a number (optional sign, digits with
# an optional fraction, optional exponent; surrounding blanks allowed).
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Fixed value: the shape of ISO text, a date with an optional time of day and zone.
ISO_PATTERN = r"^\d{4}-\d{1,2}(-\d{1,2}([T ]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?(\s*(Z|[+-]\d{1,2}(:?\d{2})?))?)?)?$"


def _null_double() -> Column:
    return F.lit(None).cast("double")


def has(df: DataFrame, name: str) -> bool:
    """Column presence test (every input column is optional)."""
    return name in df.columns


def _dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def as_number(df: DataFrame, name: str) -> Column:
    """``name`` as double; junk, NaN and absent columns give null."""
    if not has(df, name):
        return _null_double()
    dt = _dtype(df, name)
    c = F.col(name)
    if isinstance(dt, T.StringType):
        c = F.when(c.rlike(NUMBER_PATTERN), F.trim(c).try_cast("double"))
    elif isinstance(dt, T.NumericType):
        c = c.cast("double")
    elif isinstance(dt, T.BooleanType):
        c = c.cast("int").cast("double")
    else:
        return _null_double()
    return F.when(F.abs(c) < F.lit(float("inf")), c)  # NaN is larger than any number


def _parsed(c: Column, kind: str, formats) -> Column:
    """Trimmed text as ``date`` or ``timestamp``: ISO, then each of ``formats`` in turn."""
    text = F.trim(c)
    parsed = [F.when(text.rlike(ISO_PATTERN), text.try_cast(kind))]
    parsed += [F.try_to_timestamp(text, F.lit(f)).cast(kind) for f in formats]
    return F.coalesce(*parsed)


def as_date(df: DataFrame, name: str, formats=()) -> Column:
    """``name`` as DATE (ISO text or ``formats``, dates, timestamps); otherwise null.

    ``formats`` are Spark datetime patterns (such as ``MM/dd/yyyy``), tried in order.
    """
    if not has(df, name):
        return F.lit(None).cast("date")
    dt = _dtype(df, name)
    c = F.col(name)
    if isinstance(dt, T.DateType):
        return c
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("date")
    if isinstance(dt, T.StringType):
        return _parsed(c, "date", formats)
    return F.lit(None).cast("date")


def as_timestamp(df: DataFrame, name: str, formats=()) -> Column:
    """``name`` as TIMESTAMP (session time zone; ISO text or ``formats``); otherwise null."""
    if not has(df, name):
        return F.lit(None).cast("timestamp")
    dt = _dtype(df, name)
    c = F.col(name)
    if isinstance(dt, T.TimestampType):
        return c
    if isinstance(dt, (T.DateType, T.TimestampNTZType)):
        return c.cast("timestamp")
    if isinstance(dt, T.StringType):
        return _parsed(c, "timestamp", formats)
    return F.lit(None).cast("timestamp")


def month_key(date_col: Column) -> Column:
    """``yyyy-MM`` text month of a date; null stays null."""
    return F.date_format(date_col, "yyyy-MM")


def flag(predicate: Column) -> Column:
    """0/1 integer flag; a predicate that is null (missing data) is 0."""
    return F.coalesce(predicate, F.lit(False)).cast("int")


def round_half_even(c: Column, decimals: int) -> Column:
    """Round like numpy / pandas ``round``: scale, round the binary value half-to-even, unscale.

    (``bround`` rounds the shortest decimal text instead, which differs on
    values such as 45.19875.) ``+ 0.0`` turns a rounded ``-0.0`` into ``0.0``.
    """
    scale = F.lit(float(10 ** decimals))
    return F.rint(c.cast("double") * scale) / scale + F.lit(0.0)


def pct(part: Column, whole: Column, decimals: int = 4) -> Column:
    """Percentage, half-even rounded; a zero or null denominator gives null."""
    return round_half_even(F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double")), decimals)


def round4(c: Column) -> Column:
    """Measures are reported half-even rounded to 4 decimals."""
    return round_half_even(c, 4)


def typed_table(df: DataFrame, numeric=(), dates=(), timestamps=(), formats=()) -> DataFrame:
    """One projection coercing the declared, present fields (numbers, dates,
    timestamps); everything else is left as read. For a silver layer typed once."""
    conv = {}
    for name in numeric:
        if has(df, name):
            conv[name] = as_number(df, name)
    for name in dates:
        if has(df, name):
            conv[name] = as_date(df, name, formats)
    for name in timestamps:
        if has(df, name):
            conv[name] = as_timestamp(df, name, formats)
    return df.withColumns(conv) if conv else df
