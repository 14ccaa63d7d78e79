"""Bands used by the product dimension and the sales analyses.

The labels and limits below are fixed values: results must carry exactly these texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exclusive upper limit and label, the last label takes the rest.
PRICE_BANDS = [
    (100, "Budget (< 100)"),
    (500, "Mid-Range (100-500)"),
    (1000, "Premium (500-1000)"),
    (3000, "Luxury (1000-3000)"),
    (None, "Ultra-Luxury (3000+)"),
]
WEIGHT_BANDS = [
    (5, "Very Light (< 5 kg)"),
    (10, "Light (5-10 kg)"),
    (20, "Medium (10-20 kg)"),
    (None, "Heavy (20+ kg)"),
]
# Inclusive upper limit and label, exact zero comes first.
DISCOUNT_BANDS = [
    ("0", "No Discount"),
    ("0.05", "1-5% Discount"),
    ("0.10", "6-10% Discount"),
    ("0.20", "11-20% Discount"),
    (None, "20%+ Discount"),
]


def _first_true(cases: Sequence[tuple[Column, object]], default: object) -> Column:
    """CASE WHEN over (test, value) pairs."""
    out = F.when(*cases[0])
    for test, value in cases[1:]:
        out = out.when(test, value)
    return out.otherwise(default)


def _below(value: Column, bands: Sequence[tuple]) -> Column:
    return _first_true([(value < limit, label) for limit, label in bands[:-1]], bands[-1][1])


def price_band(price: str) -> Column:
    """Price range label. A NULL price fails every test and gets the last label."""
    return _below(F.col(price), PRICE_BANDS)


def weight_band(weight: str) -> Column:
    return F.when(F.col(weight).isNull(), "N/A").otherwise(_below(F.col(weight), WEIGHT_BANDS))


def discount_band(rate: str) -> Column:
    """Discount range label; a negative rate falls into the first non-zero band."""
    value = F.col(rate)
    zero = [(value == 0, DISCOUNT_BANDS[0][1])]
    upto = [(value <= F.lit(limit).cast("decimal(4,2)"), label) for limit, label in DISCOUNT_BANDS[1:-1]]
    return _first_true(zero + upto, DISCOUNT_BANDS[-1][1])


def rank_of(label: str, bands: Sequence[tuple]) -> Column:
    """Position of a band label in its list, for ordering; unknown labels go last."""
    cases = [(F.col(label) == text, position) for position, (_, text) in enumerate(bands, start=1)]
    return _first_true(cases, len(bands) + 1)
