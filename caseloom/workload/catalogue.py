"""Every registered query; importing the modules fills the registry."""

from caseloom.workload import (  # noqa: F401
    analysis_queries,
    column_queries,
    flow_queries,
    series_queries,
    warehouse_queries,
)
from caseloom.workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
