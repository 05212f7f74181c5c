"""Column expressions that turn raw text into numbers, times and days.

Nothing here depends on the session time zone: every time is ``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cell texts read as null.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Trusted time range and the window in which a number is an epoch in ms.
EARLIEST = "1970-01-01 00:00:00"
LATEST = "2200-01-01 00:00:00"
EPOCH_MS_ABOVE = 1e11
EPOCH_MS_BELOW_ON_READ = 7.2e12
EPOCH_MS_BELOW_AT_INGEST = 7.3e12  # wide enough that only LATEST decides

NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def null_tokens_to_null(cell: Column) -> Column:
    return F.when(~cell.isin(*NULL_TOKENS), cell)


def finite(x: Column) -> Column:
    """Null for NaN and both infinities (NaN sorts above infinity in Spark)."""
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def parse_number(text: Column) -> Column:
    """Text to double; anything that is not a plain finite number is null."""
    trimmed = F.trim(text)
    return finite(F.when(trimmed.rlike(NUMBER_PATTERN), trimmed.try_cast("double")))


#: a time of day followed by an offset or the name of a zone
ZONED_TIME = r":\d{2}(\.\d+)?\s*([+-]\d|[A-Za-z])"


def in_trusted_range(ts: Column) -> Column:
    return F.when(ts.between(_ntz(EARLIEST), _ntz(LATEST)), ts)


def _dashed(text: Column) -> Column:
    """Bring ``20240104`` and ``01/05/2024`` to ISO order so that one cast reads them all."""
    return (
        F.when(text.rlike(r"^\d{8}$"), F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"))
        .when(F.contains(text, F.lit("/")),
              F.regexp_replace(text, r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2"))
        .otherwise(text)
    )


def parse_time(text: Column, epoch_below: float = EPOCH_MS_BELOW_ON_READ) -> Column:
    """Epoch milliseconds or ISO-like text to ``timestamp_ntz``; untrusted times are null.

    All times are local and without a zone; a text that names a zone or an offset is null, not read as
    if it had none.
    """
    trimmed = F.trim(text)
    number = parse_number(trimmed)
    from_epoch = _ntz(EARLIEST) + F.make_dt_interval(
        secs=(number / F.lit(1000.0)).cast("decimal(18,6)"))
    parsed = (
        F.when((number > EPOCH_MS_ABOVE) & (number < epoch_below), from_epoch)
        .when((number > EPOCH_MS_ABOVE) | trimmed.rlike(ZONED_TIME), None)
        .otherwise(_dashed(trimmed).try_cast("timestamp_ntz"))
    )
    return in_trusted_range(parsed)


def as_number(df: DataFrame, name: str) -> Column:
    """A column of ``df`` as finite double, whatever its stored type."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_number(F.col(name))
    return finite(F.col(name).cast("double"))


def as_time(df: DataFrame, name: str) -> Column:
    """A column of ``df`` as trusted ``timestamp_ntz``, whatever its stored type."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return in_trusted_range(F.col(name).cast("timestamp_ntz"))
    return parse_time(F.col(name).cast("string"))


def calendar_day(ts: Column) -> Column:
    return ts.cast("date")


def wake_day(ts: Column) -> Column:
    """The day a night belongs to: shifted by six hours, so 23:00 counts to the next morning."""
    return (ts + F.expr("interval 6 hours")).cast("date")


def seconds_between(start: Column, end: Column) -> Column:
    return (end - start).cast("interval second").cast("decimal(20,6)").cast("double")


def minutes_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / F.lit(60.0)


def clip(x: Column, lo: float = 0.0, hi: float = 100.0) -> Column:
    """Null stays null; plain least/greatest would skip it."""
    return F.when(x.isNotNull(), F.least(F.lit(hi), F.greatest(F.lit(lo), x)))


def round_half_even(x: Column, digits: int) -> Column:
    scale = F.lit(float(10 ** digits))
    return F.rint(x * scale) / scale
