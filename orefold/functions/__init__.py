from orefold.functions.bands import DISCOUNT_BANDS, PRICE_BANDS, discount_band, price_band, rank_of, weight_band
from orefold.functions.change import changed
from orefold.functions.columns import (
    blank_to_null,
    content_digest,
    date_key,
    digit_id,
    fill_text,
    mask_text,
    row_hash,
    safe_measure,
    snake_case,
)

__all__ = [
    "DISCOUNT_BANDS", "PRICE_BANDS", "blank_to_null", "changed", "content_digest", "date_key", "digit_id",
    "discount_band", "fill_text", "mask_text", "price_band", "rank_of", "row_hash", "safe_measure",
    "snake_case", "weight_band",
]
