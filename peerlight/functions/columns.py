"""Column expressions: key, date and number cleaning on built-in Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from peerlight.names import KEY_LENGTH

# Accepted date spellings, as (shape, Spark pattern).
DATE_FORMATS = (
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def normalize_key(value: Column | str, strip_decimal: bool = True) -> Column:
    """Ten-character provider key: text, trimmed, zero-padded on the left, cut after ten.

    `strip_decimal` first drops a trailing `.0` left by a numeric reader. NULL stays NULL.
    """
    text = _col(value).cast("string")
    if strip_decimal:
        text = F.when(text.endswith(".0"), F.substr(text, F.lit(1), F.length(text) - 2)).otherwise(text)
    return F.lpad(F.trim(text), KEY_LENGTH, "0")


def parse_flexible_date(value: Column | str) -> Column:
    """Date from any of the accepted spellings; NULL for other text and impossible days."""
    text = _col(value).cast("string")
    return F.coalesce(
        *[F.when(text.rlike(shape), F.try_to_date(text, pattern)) for shape, pattern in DATE_FORMATS]
    )


def number_or_zero(value: Column | str) -> Column:
    """Double with NULL, NaN and unreadable text as 0.0; infinities stay."""
    return F.nanvl(F.coalesce(_col(value).try_cast("double"), F.lit(0.0)), F.lit(0.0))


def finite_or_zero(value: Column | str) -> Column:
    """Double with NULL, NaN, infinities and unreadable text as 0.0."""
    number = _col(value).try_cast("double")
    # NaN sorts above infinity in Spark, so one comparison rejects NULL, NaN and both infinities.
    return F.when(F.abs(number) < F.lit(float("inf")), number).otherwise(F.lit(0.0))


def clamp_unit(value: Column | str) -> Column:
    """Value limited to [0, 1]; NULL becomes 0 and NaN becomes 1."""
    return F.least(F.greatest(_col(value), F.lit(0.0)), F.lit(1.0))


def ratio_or_zero(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as double, 0.0 where the denominator is 0 or NULL."""
    below = _col(denominator)
    return F.when(below != 0, _col(numerator) / below).otherwise(F.lit(0.0))


def exact_sum(value: Column | str) -> Column:
    """Sum of a money column that does not depend on the order tasks finish in.

    Amounts below 1e15 are added as decimals of eight places and larger ones, below 1e23, as decimals of
    four, so two runs on different partitionings agree to the last bit. Digits beyond the eighth place,
    where a quotient of cents has its last-bit noise, are rounded away. Only what no decimal holds (NaN,
    infinities, sizes from 1e23 on) is added as doubles.
    """
    number = _col(value).cast("double")
    size = F.abs(number)
    usual, large = size < F.lit(1e15), size < F.lit(1e23)
    # Most amounts are decimals of at most eight places and six digits before them: where units / 1e8 is the very
    # double that was read, its decimal is just these units, which are added as two 64-bit numbers.
    near = F.rint(number * 1e8)
    short = (size < F.lit(1e6)) & (near / 1e8 == number)
    units = F.when(short, near.cast("long"))
    high, low = F.sum(F.shiftright(units, 30)), F.sum(units.bitwiseAND(F.lit((1 << 30) - 1)))
    whole = high.cast("decimal(17,0)") * F.lit(1 << 30).cast("decimal(10,0)") + low.cast("decimal(19,0)")
    rest = F.sum(F.when(usual & ~short, number.cast("decimal(28,8)"))).cast("decimal(36,8)")
    nothing = F.lit(0).cast("decimal(36,8)")
    unit = F.lit("0.00000001").cast("decimal(8,8)")
    small = F.coalesce((whole.cast("decimal(27,0)") * unit).cast("decimal(36,8)"), nothing) + F.coalesce(rest, nothing)
    parts = [
        F.when(whole.isNotNull() | rest.isNotNull(), small.cast("double")),
        F.sum(F.when(~usual & large, number.cast("decimal(28,4)"))).cast("double"),
        F.sum(F.when(~large, number)),
    ]
    some = F.coalesce(*parts)
    return F.when(some.isNotNull(), sum((F.coalesce(part, F.lit(0.0)) for part in parts[1:]), F.coalesce(parts[0], F.lit(0.0))))
