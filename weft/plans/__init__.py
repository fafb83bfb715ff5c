"""Registered queries, each beside the SQL that states its result."""

from weft.plans import aggregates, columns, joins, ordering, storage, text, userdefined
from weft.plans.registry import REGISTRY, Query

__all__ = ["REGISTRY", "Query"]

_MODULES = (text, columns, aggregates, joins, ordering, storage, userdefined)
