"""The standing analyst questions, each one call over a graph or the result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeline.operators import filters, lookups, statistics, traversal, views
from edgeline.schema import Graph


def _resolved(graph: Graph, entity: str) -> DataFrame:
    """The entity's edges whose both ends are known nodes."""
    own = filters.edges_of(graph.edges, entity)
    if graph.nodes is None:
        return filters.with_endpoints(own)
    return views.enriched_edges(Graph(own, graph.nodes, graph.cols))


def biggest_hubs(graph: Graph, n: int = 10) -> DataFrame:
    return lookups.top_hubs(views.node_degree(graph), n)


def reachable_from(graph: Graph, entity: str, hops: int = 3) -> DataFrame:
    """Every directed walk from the entity, nearest first."""
    return views.downstream(graph, entity, hops).select("reached_id", "hop", "path").orderBy("hop", "reached_id")


def what_connects(graph: Graph, a: str, b: str) -> DataFrame:
    return traversal.connects(graph, a, b)


def relations_by_predicate(graph: Graph, entity: str) -> DataFrame:
    return statistics.entity_relations(_resolved(graph, entity), entity)


def predicate_overview(graph: Graph) -> DataFrame:
    return statistics.predicate_stats(graph.edges)


def isolated_entities(graph: Graph) -> DataFrame:
    return lookups.isolated(views.node_degree(graph))


def confident_relations(graph: Graph, entity: str, threshold: float = 0.8) -> DataFrame:
    return statistics.entity_profile(_resolved(graph, entity), entity, threshold)


def largest_communities(communities: DataFrame, n: int = 10) -> DataFrame:
    return lookups.largest_communities(communities, n)


def most_central(centrality: DataFrame, n: int = 10) -> DataFrame:
    return lookups.top_central_entities(centrality, n)


def same_cluster(communities: DataFrame, entity: str) -> DataFrame:
    """Who else is in the entity's community."""
    own = lookups.cluster_of(communities, entity)
    # `own` is one row by construction.
    return (
        communities.join(F.broadcast(own), "community_id")
        .select("entity_id", "entity_type", "community_size")
        .orderBy("entity_id")
    )
