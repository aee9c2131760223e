"""Knowledge-graph analytics on Spark tables: one row per typed, directed, scored relationship."""

from edgeline.functions.sql_functions import register_functions, register_persistent_functions
from edgeline.plans.batch import refresh_results
from edgeline.runtime import session
from edgeline.schema import (
    CENTRALITY_SCHEMA,
    COMMUNITIES_SCHEMA,
    REGISTRY_SCHEMA,
    TRIPLET_SCHEMA,
    Graph,
    GraphColumns,
    conform_triplets,
)

__all__ = [
    "CENTRALITY_SCHEMA",
    "COMMUNITIES_SCHEMA",
    "REGISTRY_SCHEMA",
    "TRIPLET_SCHEMA",
    "Graph",
    "GraphColumns",
    "conform_triplets",
    "refresh_results",
    "register_functions",
    "register_persistent_functions",
    "session",
]
