from eventlens.functions.columns import (
    category_label,
    health_band,
    hash_partition,
    is_present,
    lag_percent,
    latency_ms,
    percent,
    round_robin_partition,
    routing_key,
)

__all__ = [
    "category_label", "health_band", "hash_partition", "is_present", "lag_percent",
    "latency_ms", "percent", "round_robin_partition", "routing_key",
]
