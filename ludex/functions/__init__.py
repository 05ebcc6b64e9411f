from ludex.functions.columns import (
    hash_bucket, in_train, safe_div, rnd, rating_ladder, transition_keep,
    conversion_weight,
)

__all__ = [
    "hash_bucket", "in_train", "safe_div", "rnd", "rating_ladder",
    "transition_keep", "conversion_weight",
]
