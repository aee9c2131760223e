"""Two graphs derived from the sample tables, in Spark and in SQL.

`moves`: one edge from each event's user to the user of the next event of that day.
`fk`: the foreign keys of the order tables; `forest` is its region-nation part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edgeline.operators.extraction import make_triplets
from edgeline.runtime import materialize
from edgeline.schema import Graph, conform_triplets

AGENT_OF_EVENT = {
    "click": "relationship",
    "view": "statistical_analysis",
    "purchase": "llm_semantic",
    "error": "ml_clustering",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def next_user(events: DataFrame) -> DataFrame:
    """Events with the user of the day's next event.

    Days may be huge, so events are ordered inside each minute only; the last event of
    a minute takes the first user of the next minute that has events, found among at
    most 1,440 rows per day.
    """
    order = ("ts", "event_id")
    minute = F.date_trunc("minute", "ts")
    timed = events.withColumn("minute", minute)
    inside = Window.partitionBy("minute").orderBy(*order)
    firsts = timed.groupBy("minute").agg(F.min_by("user_id", F.struct(*order)).alias("first_user"))
    day = Window.partitionBy(F.to_date("minute")).orderBy("minute")
    following = firsts.select("minute", F.lead("first_user").over(day).alias("minute_next"))
    return (
        timed.withColumn("inside_next", F.lead("user_id").over(inside))
        .join(following, "minute")
        .withColumn("next_user", F.coalesce("inside_next", "minute_next"))
        .filter(F.col("next_user").isNotNull())
    )


def moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = next_user(table(spark, sf_dir, "events"))
    agent = F.lit(None).cast("string")
    for event_type, name in AGENT_OF_EVENT.items():
        agent = F.when(F.col("event_type") == event_type, name).otherwise(agent)
    score = F.when(F.col("event_type") != "signup", F.least(F.lit(1.0), F.col("value") / 200))
    return conform_triplets(
        events.select(
            F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("subject_id"),
            F.lit("User").alias("subject_type"),
            F.upper("event_type").alias("predicate"),
            F.concat(F.lit("U"), F.col("next_user").cast("string")).alias("object_id"),
            F.lit("User").alias("object_type"),
            score.alias("confidence"),
            agent.alias("source_agent"),
            F.col("event_type").alias("source_method"),
            F.col("props").alias("properties"),
            F.col("ts").alias("created_at"),
        )
    )


def saved(df: DataFrame) -> DataFrame:
    """The graph written once, for queries that read it in several passes."""
    return materialize(df)[0]


MOVES = """
moves AS (
  SELECT 'U' || user_id AS subject_id, 'User' AS subject_type, upper(event_type) AS predicate,
         'U' || next_user AS object_id, 'User' AS object_type,
         CASE WHEN event_type <> 'signup' THEN least(CAST(1 AS DOUBLE), value / 200) END AS confidence,
         CASE event_type WHEN 'click' THEN 'relationship' WHEN 'view' THEN 'statistical_analysis'
              WHEN 'purchase' THEN 'llm_semantic' WHEN 'error' THEN 'ml_clustering' END AS source_agent,
         event_type AS source_method, props AS properties, ts AS created_at
  FROM (SELECT *, lead(user_id) OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) AS next_user FROM events)
  WHERE next_user IS NOT NULL
)"""

# The rows algorithms run on, and the vertex and pair tables made from them.
STRUCTURAL = (
    MOVES
    + """,
structural AS (
  SELECT subject_id, subject_type, object_id, object_type, confidence FROM moves
  WHERE (confidence IS NULL OR confidence >= 0)
    AND source_agent NOT IN ('graph_topology', 'ml_clustering', 'statistical_analysis')
    AND subject_id IS NOT NULL AND object_id IS NOT NULL
),
v AS MATERIALIZED (
  SELECT id, max(t) AS entity_type
  FROM (SELECT subject_id AS id, subject_type AS t FROM structural
        UNION ALL SELECT object_id, object_type FROM structural) GROUP BY id
),
e AS MATERIALIZED (SELECT DISTINCT subject_id AS src, object_id AS dst FROM structural WHERE subject_id <> object_id),
und AS MATERIALIZED (SELECT src, dst FROM e UNION SELECT dst, src FROM e)"""
)


def pair_triplets(df, child, child_type, prefix, predicate, parent, parent_type, parent_prefix) -> DataFrame:
    pairs = df.select(F.col(child).alias("c"), F.col(parent).alias("p")).distinct()
    return make_triplets(
        pairs,
        F.concat(F.lit(prefix), F.col("c").cast("string")),
        child_type,
        predicate,
        F.concat(F.lit(parent_prefix), F.col("p").cast("string")),
        parent_type,
        F.lit(1.0),
        "relationship",
        "fk_join",
    )


def forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        ("customer", "c_custkey", "Customer", "C", "IN_NATION", "c_nationkey", "Nation", "N"),
        ("supplier", "s_suppkey", "Supplier", "S", "IN_NATION", "s_nationkey", "Nation", "N"),
        ("nation", "n_nationkey", "Nation", "N", "IN_REGION", "n_regionkey", "Region", "R"),
    ]
    return reduce(DataFrame.unionByName, [pair_triplets(table(spark, sf_dir, name), *rest) for name, *rest in parts])


FOREST = """
forest AS (
  SELECT 'C' || c_custkey AS subject_id, 'Customer' AS subject_type, 'IN_NATION' AS predicate,
         'N' || c_nationkey AS object_id, 'Nation' AS object_type FROM customer
  UNION ALL SELECT 'S' || s_suppkey, 'Supplier', 'IN_NATION', 'N' || s_nationkey, 'Nation' FROM supplier
  UNION ALL SELECT 'N' || n_nationkey, 'Nation', 'IN_REGION', 'R' || n_regionkey, 'Region' FROM nation
),
member AS (
  SELECT 'C' || c_custkey AS id, 'Customer' AS entity_type, n_regionkey AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT 'S' || s_suppkey, 'Supplier', n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT 'N' || n_nationkey, 'Nation', n_regionkey FROM nation
  UNION ALL SELECT DISTINCT 'R' || n_regionkey, 'Region', n_regionkey FROM nation
),
grouped AS (
  SELECT region, CAST(dense_rank() OVER (ORDER BY min(id)) - 1 AS BIGINT) AS component_id,
         count(*) AS size FROM member GROUP BY region
),
communities AS (
  SELECT id AS entity_id, entity_type, component_id AS community_id, size AS community_size, component_id
  FROM member JOIN grouped USING (region)
)"""


def fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        ("orders", "o_orderkey", "Order", "O", "PLACED_BY", "o_custkey", "Customer", "C"),
        ("lineitem", "l_orderkey", "Order", "O", "CONTAINS", "l_partkey", "Part", "P"),
        ("lineitem", "l_partkey", "Part", "P", "SUPPLIED_BY", "l_suppkey", "Supplier", "S"),
    ]
    return reduce(
        DataFrame.unionByName,
        [pair_triplets(table(spark, sf_dir, name), *rest) for name, *rest in parts],
        forest(spark, sf_dir),
    )


FK = (
    FOREST
    + """,
fk AS MATERIALIZED (
  SELECT * FROM forest
  UNION ALL SELECT 'O' || o_orderkey, 'Order', 'PLACED_BY', 'C' || o_custkey, 'Customer' FROM orders
  UNION ALL SELECT DISTINCT 'O' || l_orderkey, 'Order', 'CONTAINS', 'P' || l_partkey, 'Part' FROM lineitem
  UNION ALL SELECT DISTINCT 'P' || l_partkey, 'Part', 'SUPPLIED_BY', 'S' || l_suppkey, 'Supplier' FROM lineitem
)"""
)


def orders_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """Order -> customer edges with an own node table: it misses some ends and has isolated suppliers."""
    edges = pair_triplets(
        table(spark, sf_dir, "orders"), "o_orderkey", "Order", "O", "PLACED_BY", "o_custkey", "Customer", "C"
    )

    def nodes_of(name, key, prefix, kind, keep):
        df = table(spark, sf_dir, name).filter(keep)
        return df.select(F.concat(F.lit(prefix), F.col(key).cast("string")).alias("id"), F.lit(kind).alias("type"))

    nodes = (
        nodes_of("customer", "c_custkey", "C", "Customer", "c_acctbal > 0")
        .unionByName(nodes_of("orders", "o_orderkey", "O", "Order", "o_orderstatus <> 'P'"))
        .unionByName(nodes_of("supplier", "s_suppkey", "S", "Supplier", "true"))
    )
    return Graph(edges, nodes)


ORDERS_GRAPH = """
placed AS (
  SELECT 'O' || o_orderkey AS subject_id, 'PLACED_BY' AS predicate, 'C' || o_custkey AS object_id FROM orders
),
known AS (
  SELECT 'C' || c_custkey AS id, 'Customer' AS type FROM customer WHERE c_acctbal > 0
  UNION ALL SELECT 'O' || o_orderkey, 'Order' FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT 'S' || s_suppkey, 'Supplier' FROM supplier
)"""
