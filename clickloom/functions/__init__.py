from clickloom.functions.columns import (
    dot,
    hash_bucket,
    hash_fraction,
    is_missing,
    positive_probability,
    round6,
    sigmoid,
    signed_log,
    vector_dot,
    z_score,
)

__all__ = [
    "dot",
    "hash_bucket",
    "hash_fraction",
    "is_missing",
    "positive_probability",
    "round6",
    "sigmoid",
    "signed_log",
    "vector_dot",
    "z_score",
]
