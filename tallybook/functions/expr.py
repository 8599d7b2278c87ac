"""Column expressions with PostgreSQL semantics, built from Spark built-ins.

Everything here returns a ``Column`` and stays inside whole-stage codegen:
no Python UDFs.  Where PostgreSQL and Spark differ, the function documents
which side it follows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.schemas import MONEY, MONEY_SUM

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_date(d: str | _dt.date) -> Column:
    return F.lit(d if isinstance(d, _dt.date) else _dt.date.fromisoformat(d))


def lit_ts(t: str | _dt.datetime) -> Column:
    """A TIMESTAMP WITHOUT TIME ZONE literal (``as_of`` values), built from
    its ISO text so that no session or process time zone is involved."""
    if isinstance(t, _dt.datetime):
        t = t.isoformat(sep=" ")
    return F.lit(_dt.datetime.fromisoformat(t).isoformat(sep=" ")).cast("timestamp_ntz")


EPOCH_NTZ = "1970-01-01 00:00:00"


def _epoch_ntz() -> Column:
    return F.lit(EPOCH_NTZ).cast("timestamp_ntz")


def as_of_or_now(as_of: str | _dt.datetime | None) -> Column:
    """``now()`` made explicit: a fixed instant when given, else the query start."""
    return lit_ts(as_of) if as_of is not None else F.current_timestamp().cast("timestamp_ntz")


# -- money ------------------------------------------------------------------
def money(c: ColumnOrName) -> Column:
    return col(c).cast(MONEY)


def money_sum(c: ColumnOrName) -> Column:
    """SUM over NUMERIC(12,2), reported as DECIMAL(38,2); NULL over no rows."""
    return F.sum(col(c)).cast(MONEY_SUM)


def fits_numeric(c: ColumnOrName, precision: int = 12, scale: int = 2) -> Column:
    """True when the value fits NUMERIC(precision, scale) (NULL stays NULL)."""
    return F.when(col(c).isNull(), F.lit(None).cast("boolean")).otherwise(
        col(c).try_cast(f"decimal({precision},{scale})").isNotNull())


# -- dates ------------------------------------------------------------------
def week_start(c: ColumnOrName) -> Column:
    """``date_trunc('week', d)`` (Monday) as DATE."""
    return F.date_trunc("week", col(c)).cast("date")


def month_start(c: ColumnOrName) -> Column:
    """``date_trunc('month', d)`` as DATE."""
    return F.date_trunc("month", col(c)).cast("date")


def plus_years(c: ColumnOrName, n: int = 1) -> Column:
    """``d + interval 'n year'``: 29 Feb clamps to 28 Feb; DATE result."""
    return F.add_months(col(c), 12 * n).cast("date")


def plus_days(c: ColumnOrName, n: int) -> Column:
    """``d + interval 'n' day`` (not the same as a year)."""
    return F.date_add(col(c), n)


def year_of(c: ColumnOrName) -> Column:
    """``extract(year from d)`` as BIGINT (PostgreSQL numeric, DuckDB BIGINT)."""
    return F.year(col(c)).cast("long")


def in_year(c: ColumnOrName, year: int) -> Column:
    """``extract(year from d) = year`` as a range of dates, which scans push down."""
    return col(c).between(lit_date(f"{year:04d}-01-01"), lit_date(f"{year:04d}-12-31"))


def between_symmetric(c: ColumnOrName, a, b) -> Column:
    """``c BETWEEN SYMMETRIC a AND b``: bounds in either order, both closed."""
    a_, b_ = (lit_date(a) if isinstance(a, str) else F.lit(a) if not isinstance(a, Column) else a,
              lit_date(b) if isinstance(b, str) else F.lit(b) if not isinstance(b, Column) else b)
    return col(c).between(F.least(a_, b_), F.greatest(a_, b_))


def epoch_seconds(c: ColumnOrName) -> Column:
    """``extract(epoch from ts)`` of a TIMESTAMP WITHOUT TIME ZONE, with
    fractional seconds, as DOUBLE (wall clock read as UTC; no session zone)."""
    return (F.timestamp_diff("MICROSECOND", _epoch_ntz(), col(c).cast("timestamp_ntz"))
            / F.lit(1_000_000.0))


def month_epoch(c: ColumnOrName) -> Column:
    """``extract(epoch from date_trunc('month', ts))`` in whole seconds."""
    return F.timestamp_diff("SECOND", _epoch_ntz(),
                            F.trunc(col(c), "month").cast("timestamp_ntz"))


def from_epoch(c: ColumnOrName) -> Column:
    """``to_timestamp(n)`` -> TIMESTAMP WITHOUT TIME ZONE (UTC wall clock)."""
    return F.timestamp_add("SECOND", col(c), _epoch_ntz())


def parse_datetime(c: ColumnOrName, fmt: str) -> Column:
    """``PARSEDATETIME(s, fmt)`` / ``to_timestamp(s, fmt)`` with a Java-style
    pattern -> TIMESTAMP WITHOUT TIME ZONE."""
    return F.to_timestamp_ntz(col(c), F.lit(fmt))


def to_local_time(c: ColumnOrName, zone: str) -> Column:
    """Wall clock in ``zone`` of a UTC wall-clock timestamp (``SET timezone``);
    independent of the session time zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), col(c).cast("timestamp_ntz"))


# -- text -------------------------------------------------------------------
def replace_once(c: ColumnOrName, search: str, repl: str) -> Column:
    """PostgreSQL ``replace``: one left-to-right pass ('a   b' -> 'a  b')."""
    return F.replace(col(c), F.lit(search), F.lit(repl))


def is_null_or_blank(c: ColumnOrName) -> Column:
    """``x IS NULL OR btrim(x) = ''`` (btrim removes spaces only)."""
    return col(c).isNull() | (F.btrim(col(c), F.lit(" ")) == "")


def trimmed_length(c: ColumnOrName) -> Column:
    """``length(trim(x))``; trim removes spaces only, tabs stay."""
    return F.length(F.btrim(col(c), F.lit(" ")))


def hex_lower(c: ColumnOrName) -> Column:
    """``encode(bytea, 'hex')``."""
    return F.lower(F.hex(col(c)))


def byte_length(c: ColumnOrName) -> Column:
    """``length(bytea)``: bytes, as BIGINT (PostgreSQL integer widened)."""
    return F.octet_length(col(c)).cast("long")


def anchored_match(c: ColumnOrName, pattern: str) -> Column:
    """POSIX ``~`` with ``^..$`` anchors; pass a ``\\A..\\z`` pattern so a
    trailing newline does not match (Java ``$`` would allow it)."""
    return col(c).rlike(pattern)


# Data-URI prefixes that identify a stored image format.
IMAGE_PREFIXES = (("data:image/jpeg;base64,", "jpeg"), ("data:image/png;base64,", "png"))


def image_format_from_prefix(c: ColumnOrName) -> Column:
    """Format named by the data-URI prefix of the image bytes, else 'undefined'."""
    out = F.lit("undefined")
    for prefix, fmt in reversed(IMAGE_PREFIXES):
        out = F.when(F.startswith(col(c), F.lit(prefix.encode())), F.lit(fmt)).otherwise(out)
    return out


def guid_from(*parts: ColumnOrName) -> Column:
    """Deterministic UUID-shaped key from the given columns (replaces
    ``uuid_generate_v4()`` where results must be reproducible)."""
    h = F.sha2(F.concat_ws("|", *[col(p).cast("string") for p in parts]), 256)
    return F.concat_ws("-", F.substr(h, F.lit(1), F.lit(8)), F.substr(h, F.lit(9), F.lit(4)),
                       F.substr(h, F.lit(13), F.lit(4)), F.substr(h, F.lit(17), F.lit(4)),
                       F.substr(h, F.lit(21), F.lit(12)))


def sha256_hex(c: ColumnOrName) -> Column:
    return F.sha2(col(c).cast("string"), 256)


def flag_count(*conds: Column) -> Column:
    """``CASE WHEN c THEN 1 ELSE 0 END + ...`` over several conditions."""
    total = F.lit(0)
    for c in conds:
        total = total + F.when(c, 1).otherwise(0)
    return total
