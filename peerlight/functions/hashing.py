"""Stable hashes that turn a row's key into a number in [0, 1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Odd 32-bit multipliers, so the split and the sampling draw differently.
SPLIT_MULTIPLIER = 2654435761
SAMPLE_MULTIPLIER = 2246822519
SEED_STEP = 1013904223
_RANGE = 1 << 32
_KEY_RANGE = 1 << 31


def key_number(provider_id: str, year: str | None = None) -> Column:
    """Integer below 2^31 for a provider key, mixed with the year where one is given.

    Digit keys are used as numbers; other text falls back to its CRC.
    """
    number = F.coalesce(F.col(provider_id).try_cast("bigint"), F.crc32(F.col(provider_id).cast("binary")))
    number = F.pmod(number, F.lit(_KEY_RANGE))
    if year is not None:
        number = F.pmod(number * 100 + F.pmod(F.col(year).cast("bigint"), F.lit(100)), F.lit(_KEY_RANGE))
    return number


def unit_hash(
    provider_id: str, year: str | None = None, *, multiplier: int = SPLIT_MULTIPLIER, seed: int = 0
) -> Column:
    """Number in [0, 1) that depends on the key, the multiplier and the seed only.

    The same row gets the same number whatever the partitioning, so a split or a sample built
    on it survives task retries and repeats between runs.
    """
    mixed = key_number(provider_id, year) * F.lit(multiplier) + F.lit(seed * SEED_STEP)
    return F.pmod(mixed, F.lit(_RANGE)) / F.lit(float(_RANGE))
