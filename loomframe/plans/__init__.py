"""Every operator as a query over the test tables, each with its check in SQL.

Importing this package fills the registry.
"""

from loomframe.plans import (  # noqa: F401
    aggregate_queries,
    change_queries,
    document_queries,
    feature_queries,
    filter_queries,
    join_queries,
    lifecycle_queries,
    many_queries,
    model_queries,
    scalar_queries,
    source_queries,
    statistic_queries,
    stream_queries,
    tree_queries,
)
from loomframe.plans.registry import CHECKS, QUERIES  # noqa: F401
