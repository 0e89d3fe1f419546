from peerlight.registry import more as _more  # registers its queries
from peerlight.registry.queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
