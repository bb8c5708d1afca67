"""DataFrame -> DataFrame operators (joins, aggregates, generators, order)."""

from ratelens.operators.aggregates import (
    as_partial,
    avg_count_by,
    best_group,
    conditional_avgs,
    pre_aggregate,
)
from ratelens.operators.dedup import last_wins
from ratelens.operators.generators import explode_tokens
from ratelens.operators.joins import (
    broadcast_limit,
    detect_hot_keys,
    estimate,
    fits_broadcast,
    hot_keys,
    lookup_join,
    measure,
    salted_join,
)
from ratelens.operators.ordering import file_order_position, with_position

__all__ = [
    "as_partial", "avg_count_by", "best_group", "conditional_avgs", "pre_aggregate",
    "last_wins", "explode_tokens",
    "broadcast_limit", "detect_hot_keys", "estimate", "fits_broadcast",
    "hot_keys", "lookup_join", "measure", "salted_join",
    "file_order_position", "with_position",
]
