"""The batch run: structural graph -> both result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from edgeline.functions.sql_functions import standing_of
from edgeline.operators.filters import ANNOTATING_AGENTS, structural_edges
from edgeline.operators.results import entity_centrality, entity_communities
from edgeline.operators.vertices import index_graph
from edgeline.sources.tables import read_table, write_result


def refresh_results(
    triplets: DataFrame,
    centrality_target: str,
    communities_target: str,
    threshold: float = 0.0,
    excluded: Sequence[str] = ANNOTATING_AGENTS,
) -> None:
    """Index the graph once and write centrality and communities from it.

    Beside the centrality, as `<centrality_target>_standing`, stand its rows with their places by PageRank.
    """
    graph = index_graph(structural_edges(triplets, threshold, excluded))
    write_result(entity_centrality(triplets, graph=graph), centrality_target)
    written = read_table(triplets.sparkSession, centrality_target)
    write_result(standing_of(written), f"{centrality_target}_standing")
    write_result(entity_communities(triplets, graph=graph), communities_target)
