"""Query plans; importing this package fills the registry."""

from tributary.plans import (  # noqa: F401
    aggregate_queries,
    cdc_queries,
    file_queries,
    join_queries,
    medallion_queries,
    quality_queries,
    scalar_queries,
    search_queries,
    segment_queries,
    shaping_queries,
    stream_queries,
    window_queries,
)
from tributary.plans.registry import QUERIES  # noqa: F401
