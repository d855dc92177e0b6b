"""Column expressions shared by the operators.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# Seeded hashing. A row's random draws depend only on (tag, id), never on the
# partition count or task order, so a rerun (or a retried task) yields the same
# rows. One md5 digest is cut into four 32-bit windows; DuckDB can compute the
# same number with cast('0x' || substr(md5(..), k, 8) as bigint).
# ---------------------------------------------------------------------------

def digest(tag: str, id_col: ColumnOrName) -> Column:
    """Hex md5 of `tag || id` (32 hex digits)."""
    return F.md5(F.concat(F.lit(tag), _col(id_col).cast("string")))


def hash_window(hex_digest: Column, window: int) -> Column:
    """Unsigned 32-bit integer from the `window`-th (0..3) 8-digit slice.

    Each 16-digit half is converted once (as a signed 64-bit number, base
    -10) and split with shifts and masks; the same half used by two windows
    is one common subexpression, so a digest costs two conversions.
    """
    if not 0 <= window <= 3:
        raise ValueError("window must be 0..3")
    half = F.conv(F.substring(hex_digest, 1 + 16 * (window // 2), 16), 16, -10).cast("bigint")
    if window % 2 == 0:
        return F.shiftrightunsigned(half, 32)
    return half.bitwiseAND(F.lit(0xFFFFFFFF))


def uniform(hex_digest: Column, window: int, scale: float) -> Column:
    """Double in [0, scale) from one hash window."""
    return hash_window(hex_digest, window) / F.lit(4294967296.0) * F.lit(float(scale))


def pick(values: list[str], index: Column) -> Column:
    """values[index] for a 0-based integer column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


# ---------------------------------------------------------------------------
# Text formats
# ---------------------------------------------------------------------------

def symbol_name(index: ColumnOrName) -> Column:
    """Ticker name for a symbol number: 0..99 -> SY00..SY99, else S<n>."""
    i = _col(index).cast("bigint")
    return (F.when(i < 100, F.concat(F.lit("SY"), F.lpad(i.cast("string"), 2, "0")))
            .otherwise(F.concat(F.lit("S"), i.cast("string"))))


def time_text(hour: Column, minute: Column, second: Column, millis: Column) -> Column:
    """`HH:mm:ss.SSS` text from integer parts."""
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":"),
                    F.lpad(minute.cast("string"), 2, "0"), F.lit(":"),
                    F.lpad(second.cast("string"), 2, "0"), F.lit("."),
                    F.lpad(millis.cast("string"), 3, "0"))


# Time-of-day texts: seconds and their fraction may be missing, the hour may have one digit.
_TIME_OF_DAY = r"^\s*([01]?[0-9]|2[0-3]):[0-5]?[0-9](?::[0-5]?[0-9](?:[.][0-9]{0,9})?)?\s*$"


def hour_of_text(time_col: ColumnOrName) -> Column:
    """Hour of a time-of-day or timestamp text; NULL (not a failed query) for any other text.

    `hour('12:00:00.000')` relies on an implicit cast that raises under ANSI
    mode for one bad row; here texts that are no time give NULL instead.
    """
    c = _col(time_col)
    digits = F.regexp_extract(c, _TIME_OF_DAY, 1)
    return F.when(digits != "", digits.cast("int")).otherwise(F.hour(c.try_cast("timestamp_ntz")))


def decimal_text(unscaled: ColumnOrName, precision: int = 10, scale: int = 4) -> Column:
    """Text of decimal(precision, scale) built from an unscaled integer.

    Exact decimal arithmetic (no double on the way): 12345678 -> '1234.5678'.
    """
    u = _col(unscaled).cast(f"decimal({precision},0)")
    return (u / F.lit(10 ** scale).cast(f"decimal({scale + 1},0)")).cast(
        f"decimal({precision},{scale})").cast("string")


# ---------------------------------------------------------------------------
# Exact floating sums: summing as decimal makes the result independent of the
# order rows meet the aggregate (partitioning, AQE, retries).
# ---------------------------------------------------------------------------

def exact_sum(c: ColumnOrName, precision: int = 18, scale: int = 2) -> Column:
    """Sum of a double column computed as decimal, returned as the decimal."""
    return F.sum(_col(c).cast(f"decimal({precision},{scale})"))


def exact_sum_double(c: ColumnOrName, precision: int = 18, scale: int = 2) -> Column:
    return exact_sum(c, precision, scale).cast("double")


def exact_avg(c: ColumnOrName, precision: int = 18, scale: int = 2) -> Column:
    """Average as exact-sum / count (double), NULLs ignored as in `avg`."""
    return exact_sum_double(c, precision, scale) / F.count(_col(c))
