"""Column expressions (built-in Spark functions only)."""

from groundstop.functions.hashing import content_key, hash_order, hash_prefix, hash_sample, hash_threshold
from groundstop.functions.scalars import (
    blank_to_null,
    date_from_parts,
    directed_route,
    epoch_ms_to_timestamp,
    flag_text,
    flight_id,
    hour_of_departure,
    hour_padded_ref,
    hour_text,
    iso_week,
    number_text,
    rate_percent,
    route_key,
    yes_no,
)

__all__ = [
    "blank_to_null",
    "content_key",
    "date_from_parts",
    "directed_route",
    "epoch_ms_to_timestamp",
    "flag_text",
    "flight_id",
    "hash_order",
    "hash_prefix",
    "hash_sample",
    "hash_threshold",
    "hour_of_departure",
    "hour_padded_ref",
    "hour_text",
    "iso_week",
    "number_text",
    "rate_percent",
    "route_key",
    "yes_no",
]
