"""All registered queries. Importing the package registers them."""

from cabrank.registry import building_blocks, ride_reports, storage_queries, streams, trip_reports  # noqa: F401
from cabrank.registry.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
