from .columns import (
    bin_rating,
    blank_to_null,
    date_parts,
    dot,
    evaluated_once,
    histogram,
    int_field,
    key_fraction,
    kl_divergence,
)

__all__ = [
    "bin_rating",
    "blank_to_null",
    "date_parts",
    "dot",
    "evaluated_once",
    "histogram",
    "int_field",
    "key_fraction",
    "kl_divergence",
]
