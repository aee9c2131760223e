"""The traversal and lookup operators as SQL functions over temporary views.

Bodies are plain SQL, so Spark inlines each call into the caller's plan. All of them take
columns under LATERAL as well as constants, and plan as equality joins. Results are whole:
add a LIMIT where a few rows are enough. Walks are spelled out level by level up to the
number of hops given when the functions are registered; a call that asks for more is an
error. A level that a call does not need has no rows to extend.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeline.operators.views import derive_nodes, enriched_edges, node_degree
from edgeline.runtime import dense_index
from edgeline.schema import Graph, conform_triplets, empty_results

FUNCTION_NAMES = (
    "neighbors",
    "khop",
    "connection_path",
    "subgraph_edges",
    "cluster_of",
    "members_of_cluster",
    "top_central_entities",
    "shared_community",
    "downstream",
    "upstream",
)

NEIGHBORS = """
neighbors(entity_id STRING)
RETURNS TABLE (predicate STRING, neighbor_id STRING, neighbor_type STRING, direction STRING, confidence DOUBLE)
RETURN
  SELECT predicate, object_id, object_type, 'out', confidence
  FROM {triplets} WHERE subject_id = neighbors.entity_id
  UNION ALL
  SELECT predicate, subject_id, subject_type, 'in', confidence
  FROM {triplets} WHERE object_id = neighbors.entity_id
"""

# Hops that calls may ask for, unless `register_functions` is told otherwise.
MAX_HOPS = 6
MAX_PATH_HOPS = 4

# Neighbours in either direction, a row per edge: every level and step takes distinct rows itself, after it
# has kept the few it needs. All joins are on `src`, so the pairs are shuffled once for all of them. Levels ask for
# that by a hint: by the size of the files the planner takes two rows per edge for few enough to be broadcast.
PAIRS = """pair AS (
    SELECT p.src, p.dst FROM {triplets}
    LATERAL VIEW inline(array(
      named_struct('src', subject_id, 'dst', object_id), named_struct('src', object_id, 'dst', subject_id)
    )) p
    WHERE p.src IS NOT NULL AND p.dst IS NOT NULL
  )"""


def _levels(name: str, hops: int, wanted: str) -> str:
    """CTEs level0 .. level<hops>: every node within so many hops of the entity, with the fewest.

    Each level is used once, so the text unfolds into a chain: the nodes of the level before,
    and those next to its outermost ones. `wanted` is the number of hops the call asks for.
    """
    ctes = [f"level0 AS (SELECT {name}.entity_id AS node, 0 AS hops)"]
    for i in range(1, hops + 1):
        ctes.append(f"""level{i} AS (
    SELECT n.node, min(n.hops) AS hops
    FROM (
      SELECT /*+ MERGE(pair) */ l.node, l.hops, pair.dst
      FROM (SELECT node, hops, hops = {i - 1} AND {wanted} >= {i} AS goes_on FROM level{i - 1}) l
      LEFT JOIN pair ON pair.src = l.node AND l.goes_on
    ) LATERAL VIEW inline(array(named_struct('node', node, 'hops', hops), named_struct('node', dst, 'hops', {i}))) n
    WHERE n.node IS NOT NULL
    GROUP BY n.node
  )""")
    return ",\n  ".join(ctes)


def _allowed(name: str, hops: int) -> str:
    message = f"{name} was registered for {hops} hops; register the functions with a larger max_hops"
    return f"if({name}.k > {hops}, CAST(raise_error('{message}') AS BOOLEAN), true)"


def _khop(hops: int) -> str:
    return f"""
khop(entity_id STRING, k INT)
RETURNS TABLE (neighbor_id STRING, hops INT)
RETURN
  WITH {PAIRS},
  {_levels("khop", hops, "coalesce(khop.k, 3)")}
  SELECT node AS neighbor_id, hops FROM level{hops} WHERE hops > 0 AND {_allowed("khop", hops)}
"""


def _subgraph_edges(hops: int) -> str:
    """Nodes with the hops to them, nearest first; an edge is met one hop after its nearer end."""
    columns = "subject_id, subject_type, predicate, object_id, object_type, confidence"
    return f"""
subgraph_edges(entity_id STRING, k INT)
RETURNS TABLE (subject_id STRING, subject_type STRING, predicate STRING, object_id STRING, object_type STRING,
               confidence DOUBLE, hop INT)
RETURN
  WITH {PAIRS},
  {_levels("subgraph_edges", hops - 1, "coalesce(subgraph_edges.k, 2) - 1")},
  touching AS (
    SELECT e.node AS touched, {columns} FROM {{triplets}}
    LATERAL VIEW explode(array_distinct(array(subject_id, object_id))) e AS node
  ),
  met AS (
    SELECT {columns}, l.hops FROM level{hops - 1} l JOIN touching ON touching.touched = l.node
    WHERE {_allowed("subgraph_edges", hops)}
  )
  SELECT {columns}, min(hops) + 1 AS hop FROM met GROUP BY {columns}
"""


def _ways_back(hops: int) -> str:
    """CTEs back0 .. back<hops>: the nodes that so many hops can take to b, on a way that does not turn round.

    `lo` and `hi` are the least and the largest node that such a way goes to next: who comes from the only one
    cannot go on. b itself is among the rows, without a next node. They depend on b alone, so calls with
    the same b share them.
    """
    ctes = ["back0 AS (SELECT connection_path.b AS b, connection_path.b AS node, "
            "CAST(NULL AS STRING) AS lo, CAST(NULL AS STRING) AS hi)"]  # fmt: skip
    for i in range(1, hops + 1):
        ctes.append(f"""back{i} AS (
    SELECT b, n.node, min(n.next) AS lo, max(n.next) AS hi
    FROM (SELECT v.b, v.node, v.lo, v.hi, pair.dst FROM back{i - 1} v JOIN pair ON pair.src = v.node)
    LATERAL VIEW inline(array(
      named_struct('node', if(dst = b OR (lo = dst AND hi = dst), NULL, dst), 'next', node),
      named_struct('node', if(node = b, b, NULL), 'next', NULL)
    )) n
    WHERE n.node IS NOT NULL
    GROUP BY b, n.node
  )""")
    return ",\n  ".join(ctes)


def _paths(hops: int) -> str:
    """CTEs path1 .. path<hops - 1>: paths from a with as many inner nodes, or fewer where `len` is all they want.

    After the first hop a step only goes to a node with a way back to b in the hops left. Steps are worked out once
    per b, however many paths take them; one from b to itself is for the paths that go no further.
    """
    further = f"sequence(1, {hops - 1})" if hops > 1 else "CAST(array() AS ARRAY<INT>)"
    ctes = [f"""path1 AS (
    SELECT a, b, len, dst AS tip, if(len = 0, CAST(array() AS ARRAY<STRING>), array(dst)) AS inner
    FROM (
      SELECT DISTINCT e.a, e.b, pair.dst
      FROM (SELECT connection_path.a AS a, connection_path.b AS b) e JOIN pair ON pair.src = e.a
      WHERE e.b IS NOT NULL AND (pair.dst = e.b OR pair.dst <> e.a)
    ) LATERAL VIEW explode(if(dst = b, array(0), {further})) AS len
  )"""]
    for i in range(2, hops):
        ctes.append(f"""step{i} AS (
    SELECT DISTINCT v.b, if(v.node = v.b, v.b, pair.dst) AS near, v.node AS far
    FROM back{hops - i} v JOIN pair ON pair.src = v.node
    WHERE v.node = v.b OR pair.dst <> v.b AND (v.lo <> pair.dst OR v.hi <> pair.dst)
  ),
  path{i} AS (
    SELECT p.a, p.b, p.len, if(p.len < {i}, p.tip, s.far) AS tip, if(p.len < {i}, p.inner, array_append(p.inner, s.far)) AS inner
    FROM (SELECT a, b, len, tip, inner, if(len < {i}, b, tip) AS near FROM path{i - 1}) p
    JOIN step{i} s ON s.b = p.b AND s.near = p.near
    WHERE p.len < {i} OR (s.far <> p.a AND NOT array_contains(p.inner, s.far))
  )""")
    return ",\n  ".join(ctes)


def _connection_path(hops: int) -> str:
    """Paths grow from a, over nodes that can still reach b, and end next to b."""
    return f"""
connection_path(a STRING, b STRING)
RETURNS TABLE (hops INT, path STRING)
RETURN
  WITH {PAIRS},
  {_ways_back(max(hops - 2, 1))},
  {_paths(hops)}
  SELECT p.len + 1 AS hops, array_join(concat(array(p.a), p.inner, array(p.b)), ' -> ') AS path
  FROM path{max(hops - 1, 1)} p JOIN back1 ON back1.b = p.b AND back1.node = p.tip
"""


CLUSTER_OF = """
cluster_of(entity_id STRING)
RETURNS BIGINT
RETURN (SELECT min(c.community_id) FROM {communities} c WHERE c.entity_id = cluster_of.entity_id)
"""

MEMBERS_OF_CLUSTER = """
members_of_cluster(community_id BIGINT)
RETURNS TABLE (entity_id STRING, entity_type STRING, community_size BIGINT)
RETURN
  SELECT m.entity_id, m.entity_type, m.community_size
  FROM {communities} m
  WHERE m.community_id = members_of_cluster.community_id
"""

# The batch run, or registering the views, numbers entities by PageRank once.
TOP_CENTRAL_ENTITIES = """
top_central_entities(n INT)
RETURNS TABLE (entity_id STRING, entity_type STRING, pagerank DOUBLE, degree BIGINT, betweenness DOUBLE)
RETURN
  SELECT entity_id, entity_type, pagerank, degree, betweenness
  FROM {standing}
  WHERE place < top_central_entities.n
"""

# Both ids meet the table in one join; what it has for either is then set side by side.
SHARED_COMMUNITY = """
shared_community(a STRING, b STRING)
RETURNS TABLE (entity_a STRING, entity_b STRING, community_a BIGINT, community_b BIGINT,
               same_community BOOLEAN, community_size BIGINT)
RETURN
  WITH asked AS (SELECT explode(map(1, shared_community.a, 2, shared_community.b)) AS (side, id)),
  sides AS (
    SELECT max(if(side = 1, id, NULL)) AS a, max(if(side = 2, id, NULL)) AS b,
           max(if(side = 1, m.community_id, NULL)) AS ca, max(if(side = 2, m.community_id, NULL)) AS cb,
           max(if(side = 1, m.community_size, NULL)) AS members
    FROM asked LEFT JOIN {communities} m ON m.entity_id = id
  )
  SELECT a, b, ca, cb, ca IS NOT NULL AND ca = cb, if(ca = cb, members, NULL) FROM sides
"""

WALKS = """
{{name}}(start_id STRING)
RETURNS TABLE (start_id STRING, reached_id STRING, hop INT, path ARRAY<STRING>, predicates ARRAY<STRING>)
RETURN
  WITH one AS (
    SELECT {{far}} AS tip, array({{near}}, {{far}}) AS path, array(predicate) AS labels
    FROM {triplets} WHERE {{near}} = {{name}}.start_id AND {{far}} <> {{near}}
  ),
  two AS (
    SELECT t.{{far}} AS tip, array_append(path, t.{{far}}) AS path, array_append(labels, t.predicate) AS labels
    FROM one JOIN {triplets} t ON t.{{near}} = one.tip WHERE NOT array_contains(path, t.{{far}})
  ),
  three AS (
    SELECT t.{{far}} AS tip, array_append(path, t.{{far}}) AS path, array_append(labels, t.predicate) AS labels
    FROM two JOIN {triplets} t ON t.{{near}} = two.tip WHERE NOT array_contains(path, t.{{far}})
  )
  SELECT path[0], tip, CAST(size(labels) AS INT), path, labels
  FROM (SELECT * FROM one UNION ALL SELECT * FROM two UNION ALL SELECT * FROM three)
"""


def _walks(name: str, near: str, far: str) -> str:
    return WALKS.replace("{{name}}", name).replace("{{near}}", near).replace("{{far}}", far)


def _bodies(max_hops: int, max_path_hops: int) -> tuple[str, ...]:
    return (
        NEIGHBORS,
        _khop(max_hops),
        _connection_path(max_path_hops),
        _subgraph_edges(max_hops),
        CLUSTER_OF,
        MEMBERS_OF_CLUSTER,
        TOP_CENTRAL_ENTITIES,
        SHARED_COMMUNITY,
        _walks("downstream", "subject_id", "object_id"),
        _walks("upstream", "object_id", "subject_id"),
    )


def standing_of(centrality: DataFrame) -> DataFrame:
    """The centrality rows with their `place` by PageRank: 0 for the most central, equal ones by id."""
    order = F.struct((-F.coalesce(F.col("pagerank"), F.lit(float("-inf")))).alias("least"), "entity_id", "entity_type", "degree", "betweenness")
    numbered, _ = dense_index(centrality.withColumn("order", order), "order", "place")
    return numbered.drop("order")


def register_functions(
    spark: SparkSession,
    triplets: DataFrame,
    centrality: DataFrame | None = None,
    communities: DataFrame | None = None,
    prefix: str = "kg_",
    max_hops: int = MAX_HOPS,
    max_path_hops: int = MAX_PATH_HOPS,
) -> tuple[str, ...]:
    """Create the functions over temporary views named with `prefix`.

    The views are triplets, centrality, its rows by PageRank (standing) and communities, and
    nodes, node_degree and edges_enriched derived from the triplets. Result tables not given
    yet are registered empty, so lookups answer with no rows. `max_hops` bounds the k of
    `khop` and `subgraph_edges`, `max_path_hops` the length of connecting paths.
    """
    no_centrality, no_communities = empty_results(spark)
    views = {
        "triplets": conform_triplets(triplets),
        "centrality": no_centrality if centrality is None else centrality,
        "communities": no_communities if communities is None else communities,
        "standing": no_centrality.withColumn("place", F.lit(0)) if centrality is None else standing_of(centrality),
    }
    graph = Graph(views["triplets"])
    derived = {"nodes": derive_nodes(graph), "node_degree": node_degree(graph), "edges_enriched": enriched_edges(graph)}
    for name, df in {**views, **derived}.items():
        df.createOrReplaceTempView(prefix + name)
    _create(spark, {name: prefix + name for name in views}, "TEMPORARY ", max_hops, max_path_hops)
    return FUNCTION_NAMES


def register_persistent_functions(
    spark: SparkSession,
    triplets: str,
    centrality: str,
    communities: str,
    standing: str | None = None,
    max_hops: int = MAX_HOPS,
    max_path_hops: int = MAX_PATH_HOPS,
) -> tuple[str, ...]:
    """Create the functions in the current schema over saved tables.

    `standing` is the table `refresh_results` writes beside the centrality; without a name it
    is `<centrality>_standing`, and written now if it is missing.
    """
    standing = standing or f"{centrality}_standing"
    if not spark.catalog.tableExists(standing):
        standing_of(spark.table(centrality)).write.saveAsTable(standing)
    tables = {"triplets": triplets, "centrality": centrality, "communities": communities, "standing": standing}
    _create(spark, tables, "", max_hops, max_path_hops)
    return FUNCTION_NAMES


def _create(spark: SparkSession, tables: dict[str, str], scope: str, max_hops: int, max_path_hops: int) -> None:
    for body in _bodies(max_hops, max_path_hops):
        spark.sql(f"CREATE OR REPLACE {scope}FUNCTION {body.strip().format(**tables)}")
