"""The registered queries over the driver's tables."""

from tallyforge.workload import series_queries, stream_queries, tenant_queries, usage_queries  # noqa: F401
from tallyforge.workload.registry import ENTRIES

__all__ = ["ENTRIES"]
