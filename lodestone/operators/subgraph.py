"""Typed N-hop subgraphs: capped breadth-first search over edges between typed nodes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.text import search_text
from lodestone.session import materialize


@dataclass(frozen=True)
class EdgeType:
    """An edge table ``(from, to, ...)`` between two node types and the order in which a cap keeps edges."""

    name: str
    from_type: str
    to_type: str
    order: tuple[str, ...] = ()  # column names; a leading minus sorts downwards


def candidate_scores(nodes: DataFrame, query: str, root_name: str, fields: list[str]) -> DataFrame:
    """Nodes with ``query`` in any search field, with their matched fields and selection score."""
    needle, root = F.lit(" ".join(query.strip().casefold().split())), F.lit(" ".join(root_name.strip().casefold().split()))
    types = dict(nodes.dtypes)
    # Values of a list are searched as one text, with a mark between them that no query holds.
    has = lambda f: F.contains(search_text(F.array_join(f, "\x1f") if types[f].startswith("array") else F.col(f)), needle)
    matched = F.filter(F.array(*[F.when(F.coalesce(has(f), F.lit(False)), F.lit(f)) for f in fields]), lambda x: x.isNotNull())
    name = search_text(F.col("name"))
    points = [(name == root, 1000), (name == needle, 500), (F.array_contains("matched", "name"), 100), (F.col("id").startswith("EFO_"), 20), (F.col("id").startswith("MONDO_"), 10)]
    score = F.lit(0)
    for test, n in points:
        score = score + F.when(F.coalesce(test, F.lit(False)), n).otherwise(0)
    found = nodes.withColumn("matched", matched).filter(F.size("matched") > 0)
    return found.select("id", "name", F.array_join("matched", ",").alias("matched_fields"), score.alias("selection_score")).orderBy(F.desc("selection_score"), search_text(F.col("name")), "id")


EDGES = "edge_type string, from_type string, to_type string, `from` string, `to` string, relation string, weight double"


def root_of(candidates: DataFrame, explicit: str | None = None) -> str:
    """The id of the best candidate, or the explicit one, which must be among the candidates."""
    row = candidates.filter(F.col("id") == explicit).first() if explicit else candidates.first()
    if row is None:
        raise LookupError(f"{explicit} is no candidate" if explicit else "nothing matches")
    return row.id


def with_attributes(nodes: DataFrame, attributes: dict[str, DataFrame]) -> DataFrame:
    """Nodes with the JSON ``attributes`` of their row in the table of their type; null where there is none."""
    known = None
    for kind, table in attributes.items():
        part = table.select(F.lit(kind).alias("type"), F.col("id").cast("string").alias("id"), F.to_json(F.struct(*[c for c in table.columns if c != "id"])).alias("attributes"))
        known = part if known is None else known.unionByName(part)
    return nodes.withColumn("attributes", F.lit(None).cast("string")) if known is None else nodes.join(known, ["type", "id"], "left")


def extract_layer(tables: dict[EdgeType, DataFrame], frontier: DataFrame, cap: int) -> DataFrame:
    """Edges that touch the frontier, per type the first ``cap`` of them (0: all)."""
    out = None if tables else frontier.sparkSession.createDataFrame([], EDGES)
    for kind, edges in tables.items():
        ids = lambda t: frontier.filter(F.col("type") == t).select("id")
        a = edges.join(ids(kind.from_type).withColumnRenamed("id", "from"), "from", "left_semi")
        b = edges.join(ids(kind.to_type).withColumnRenamed("id", "to"), "to", "left_semi")
        names = ["from", "to", "relation", "weight"]
        both = a.select(*names).unionByName(b.select(*names)).groupBy("from", "to", "relation").agg(F.max("weight").alias("weight"))
        if cap:
            # A sorted limit keeps the best of every task first, so no task sees all edges of the hop.
            both = both.orderBy(*[F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in kind.order], "from", "to", "relation").limit(cap)
        part = both.select(F.lit(kind.name).alias("edge_type"), F.lit(kind.from_type).alias("from_type"), F.lit(kind.to_type).alias("to_type"), *names)
        out = part if out is None else out.unionByName(part)
    return out


def traverse(tables: dict[EdgeType, DataFrame], seeds: DataFrame, hops: int, cap: int = 25) -> tuple[DataFrame, DataFrame]:
    """``(nodes(type, id, hop), edges(edge_type, from, to, relation, weight, hop))``.

    ``seeds`` has ``type`` and ``id``.  Both ends of a kept edge are searched next if unseen; an edge
    found at several hops keeps the earliest.
    """
    frontier = materialize(seeds.select("type", "id").distinct().withColumn("hop", F.lit(0)), "hop")
    nodes, edges = frontier, None
    for hop in range(1, hops + 1):
        layer = materialize(extract_layer(tables, frontier, cap).withColumn("hop", F.lit(hop)), "hop-edges")
        edges = layer if edges is None else edges.unionByName(layer)
        ends = layer.select(F.col("from_type").alias("type"), F.col("from").alias("id")).unionByName(layer.select(F.col("to_type").alias("type"), F.col("to").alias("id"))).distinct()
        frontier = materialize(ends.join(nodes.select("type", "id"), ["type", "id"], "left_anti").withColumn("hop", F.lit(hop)), "hop")
        nodes = nodes.unionByName(frontier)
        if frontier.isEmpty():
            break
    first = Window.partitionBy("edge_type", "from", "to", "relation").orderBy("hop")
    if edges is not None:
        edges = edges.withColumn("r", F.row_number().over(first)).filter("r = 1").drop("r")
    return nodes, edges


def summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(what, kind, hop, n)`` counts of nodes and edges."""
    a = nodes.groupBy(F.lit("node").alias("what"), F.col("type").alias("kind"), "hop").agg(F.count("*").alias("n"))
    return a.unionByName(edges.groupBy(F.lit("edge").alias("what"), F.col("edge_type").alias("kind"), "hop").agg(F.count("*").alias("n")))


def violations(nodes: DataFrame, edges: DataFrame, seeds: DataFrame, hops: int, cap: int) -> dict[str, int]:
    """Counts that must all be zero."""
    ids = nodes.select("type", "id")
    ends = edges.select(F.col("from_type").alias("type"), F.col("from").alias("id")).unionByName(edges.select(F.col("to_type").alias("type"), F.col("to").alias("id"))).distinct()
    return {
        "repeated_nodes": ids.groupBy("type", "id").count().filter("count > 1").count(),
        "missing_seeds": seeds.join(ids, ["type", "id"], "left_anti").count(),
        "dangling_ends": ends.join(ids, ["type", "id"], "left_anti").count(),
        "beyond_hops": nodes.filter(F.col("hop") > hops).count(),
        "over_cap": edges.groupBy("edge_type", "hop").count().filter(F.col("count") > cap).count() if cap else 0,
    }
