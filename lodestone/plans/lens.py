"""The driver's tables seen as a knowledge graph: suppliers and parts are entities, line items assertions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators.subgraph import EdgeType
from lodestone.session import table

# Phrases that stand for the return flag and line status of an item.
PHRASES = {
    ("A", "F"): "was negatively associated with",
    ("N", "F"): "is part of the treatment for",
    ("N", "O"): "promoted the expression of",
    ("R", "F"): "was associated with an increased risk of",
    ("A", "O"): "interacts with",
    ("R", "O"): "was observed before",
}


def phrase_sql(flag: str = "l_returnflag", status: str = "l_linestatus") -> str:
    arms = " ".join(f"WHEN {flag} = '{f}' AND {status} = '{s}' THEN '{p}'" for (f, s), p in PHRASES.items())
    return f"CASE {arms} ELSE 'was observed before' END"


def raw_assertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as raw assertions; ids come from all columns, since order and line number repeat."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag", "l_linestatus")
    key = F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int"))
    return li.select(
        key.alias("raw_id"),
        F.concat(F.lit("S"), "l_suppkey").alias("subject_entity"),
        F.concat(F.lit("P"), "l_partkey").alias("object_entity"),
        F.expr(phrase_sql()).alias("phrase"),
        F.create_map(F.lit("Dose"), F.when(F.col("l_quantity") >= 25, "High  Dose").otherwise("low dose"), F.lit("study_type"), F.col("l_linestatus")).alias("qualifiers"),
        (F.col("l_returnflag") == "R").alias("negated"),
        F.lit(False).alias("speculative"),
        F.col("l_orderkey").cast("string").alias("document_id"),
        F.col("l_returnflag").alias("source"),
        (F.col("l_discount") * 10 + 0.25).alias("confidence"),
        F.col("l_linestatus").alias("evidence_text"),
    )


RAW_SQL = f"""
raw AS (
  SELECT concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INT)) AS raw_id,
         'S' || l_suppkey AS subject_entity, 'P' || l_partkey AS object_entity, {phrase_sql()} AS phrase,
         CASE WHEN l_quantity >= 25 THEN 'high dose' ELSE 'low dose' END AS dose,
         l_returnflag = 'R' AS negated, false AS speculative, CAST(l_orderkey AS VARCHAR) AS document_id,
         l_returnflag AS source, l_discount * 10 + 0.25 AS confidence, l_linestatus AS evidence_text
  FROM lineitem)"""


def identity_sql(relation: str) -> str:
    return f"""sha256('{{"negated":' || CASE WHEN negated THEN 'true' ELSE 'false' END || ',"object":"' || object_entity ||
      '","qualifiers":{{"Dose":"' || dose || '"}},"relation":"' || {relation} || '","speculative":false,"subject":"' || subject_entity || '"}}')"""


def ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(source, target, relation)`` of all line items, repeated as they are there."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.concat(F.lit("S"), "l_suppkey").alias("source"), F.concat(F.lit("P"), "l_partkey").alias("target"), F.col("l_returnflag").alias("relation"))


def sparse_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and parts joined by all line items, one edge per pair and relation."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_returnflag", "l_discount")
    ends = li.select(F.concat(F.lit("S"), "l_suppkey").alias("source"), F.concat(F.lit("P"), "l_partkey").alias("target"), F.col("l_returnflag").alias("relation"), "l_discount")
    return ends.groupBy("source", "target", "relation").agg(F.round(F.max("l_discount") + 0.5, 4).alias("confidence")).withColumn("edge_id", F.concat_ws(":", "source", "target", "relation"))


SPARSE_SQL = """
edges AS (
  SELECT source, target, relation, round(max(l_discount) + 0.5, 4) AS confidence, source || ':' || target || ':' || relation AS edge_id
  FROM (SELECT 'S' || l_suppkey AS source, 'P' || l_partkey AS target, l_returnflag AS relation, l_discount FROM lineitem)
  GROUP BY source, target, relation),
pairs AS (SELECT source AS a, target AS b FROM edges UNION SELECT target, source FROM edges)"""


#: Least reachable node of every node with a pair, by recursion over the nodes whose label falls.
COMPONENTS_SQL = """cc(node, root) USING KEY (node) AS (
  SELECT a AS node, min(least(a, b)) AS root FROM pairs GROUP BY a
  UNION
  SELECT p.a, min(c.root) FROM cc c JOIN pairs p ON p.b = c.node JOIN recurring.cc o ON o.node = p.a WHERE c.root < o.root GROUP BY p.a)"""


def walk_sql(name: str, seed: str, hops: int) -> str:
    """Depths by breadth-first search as a chain of tables, one per hop."""
    parts = [f"{name}_0 AS (SELECT DISTINCT a AS node, 0 AS depth FROM pairs WHERE a IN ({seed}))"]
    for h in range(1, hops + 1):
        parts.append(f"{name}_{h} AS (SELECT * FROM {name}_{h - 1} UNION ALL SELECT DISTINCT b, {h} FROM pairs JOIN {name}_{h - 1} ON a = node AND depth = {h - 1} WHERE b NOT IN (SELECT node FROM {name}_{h - 1}))")
    return ",\n".join([*parts, f"{name} AS (SELECT * FROM {name}_{hops})"])


def typed_tables(spark: SparkSession, sf_dir: str) -> dict[EdgeType, DataFrame]:
    """Geography and trade as typed edge tables."""
    heavy = ("-weight",)
    s = lambda c: F.col(c).cast("string")
    nation, customer, supplier, orders = (table(spark, sf_dir, t) for t in ("nation", "customer", "supplier", "orders"))
    cols = lambda df, a, b, rel, w: df.select(s(a).alias("from"), s(b).alias("to"), F.lit(rel).alias("relation"), w.cast("double").alias("weight"))
    return {
        EdgeType("nation_region", "nation", "region"): cols(nation, "n_nationkey", "n_regionkey", "in", F.lit(1.0)),
        EdgeType("supplier_nation", "supplier", "nation", heavy): cols(supplier, "s_suppkey", "s_nationkey", "based", F.col("s_acctbal")),
        EdgeType("customer_nation", "customer", "nation", heavy): cols(customer, "c_custkey", "c_nationkey", "lives", F.col("c_acctbal")),
        EdgeType("order_customer", "order", "customer", heavy): cols(orders, "o_orderkey", "o_custkey", "placed", F.col("o_totalprice")),
    }
