"""Named queries over the benchmark tables, each with its SQL counterpart."""

from tidemark.queries.registry import REGISTRY  # noqa: F401
from tidemark.queries import (  # noqa: F401
    check_queries,
    control_queries,
    entity_queries,
    relation_queries,
    source_queries,
    state_queries,
)
