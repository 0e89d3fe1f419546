from peerlight.functions.columns import (
    clamp_unit,
    exact_sum,
    finite_or_zero,
    normalize_key,
    number_or_zero,
    parse_flexible_date,
    ratio_or_zero,
)
from peerlight.functions.hashing import unit_hash

__all__ = [
    "clamp_unit",
    "exact_sum",
    "finite_or_zero",
    "normalize_key",
    "number_or_zero",
    "parse_flexible_date",
    "ratio_or_zero",
    "unit_hash",
]
