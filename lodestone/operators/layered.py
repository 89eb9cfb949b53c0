"""Frontier-bridge layered networks: two searches, carry chains to the hop limit, and a full bridge.

Inputs: ``entities(entity_id, display_name, entity_type, description)`` and ``edges(edge_id, source,
target, relation, confidence)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.hashing import percent_encoded
from lodestone.functions.text import keyword_text
from lodestone.operators.graph import adjacency, bfs, bfs_parents
from lodestone.session import materialize


class BuildError(ValueError):
    """A network that must not be written."""


def match_entities(entities: DataFrame, keywords: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """``(keyword, entity_id, field)``: normalized keyword inside a name, alias or description, or equal to the id."""
    fields = entities.select("entity_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(c).alias("value")) for f, c in (("display_name", "display_name"), ("description", "description"), ("entity_id", "entity_id"))])).alias("x")).select("entity_id", "x.field", "x.value")
    if aliases is not None:
        fields = fields.unionByName(aliases.select("entity_id", F.lit("alias").alias("field"), F.col("alias").alias("value")))
    fields = fields.withColumn("text", keyword_text(F.col("value"))).filter(F.length("text") > 0)
    wanted = keywords.select(F.col(keywords.columns[0]).alias("keyword")).withColumn("needle", keyword_text(F.col("keyword"))).filter(F.length("needle") > 0)
    hit = F.when(F.col("field") == "entity_id", F.col("text") == F.col("needle")).otherwise(F.contains("text", "needle"))
    found = None
    for block in in_blocks(wanted):
        part = fields.join(F.broadcast(block), hit).select("keyword", "entity_id", "field")
        found = part if found is None else found.unionByName(part)
    return fields.select(F.col("entity_id").alias("keyword"), "entity_id", "field").limit(0) if found is None else found.distinct()


def keywords_of(matches: DataFrame) -> DataFrame:
    """``(entity_id, matched_keywords)``: the keywords of each entity, sorted and joined by pipes."""
    return matches.groupBy("entity_id").agg(piped(F.col("keyword")).alias("matched_keywords"))


def in_blocks(queries: DataFrame, most: int = 10_000) -> list[DataFrame]:
    """A stated set of queries as tables of about ``most`` rows, each small enough to be broadcast."""
    n = -(-queries.count() // most)
    if n <= 1:
        return [queries] * n
    block = F.pmod(F.xxhash64(*queries.columns), F.lit(n))
    kept = materialize(queries.withColumn("__block", block), "query-blocks")
    return [kept.filter(F.col("__block") == i).drop("__block") for i in range(n)]


def primary_ids(external: DataFrame) -> DataFrame:
    """``(entity_id, external_id)``: the primary external id of each entity, else its least normalized one."""
    order = F.struct((~F.col("is_primary")).alias("secondary"), "normalized_id")
    return external.groupBy("entity_id").agg(F.min(order).alias("best")).select("entity_id", F.col("best.normalized_id").alias("external_id"))


def node_id(side: str, depth: Column, entity: Column) -> Column:
    return F.concat(F.lit(f"{side[0]}::d"), F.lpad(depth.cast("string"), 3, "0"), F.lit("::"), percent_encoded(entity))


def carry_id(side: str, depth: Column, entity: Column) -> Column:
    return F.concat(F.lit(f"{side[0]}::d"), F.lpad(depth.cast("string"), 3, "0"), F.lit("::carry::"), F.substring(F.sha2(entity, 256), 1, 16))


def piped(column: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(column)), "|")


@dataclass
class Side:
    distances: DataFrame
    nodes: DataFrame
    edges: DataFrame
    occurrences: DataFrame


def oriented(edges: DataFrame, distances: DataFrame, side: str, mode: str) -> DataFrame:
    """Edges that join adjacent depths, ``lower`` being the end nearer to the seeds."""
    near = distances.select(F.col("node").alias("lower"), F.col("depth").alias("d0"))
    far = distances.select(F.col("node").alias("upper"), F.col("depth").alias("d1"))
    steps = adjacency(edges, mode, side).select(F.col("node").alias("lower"), F.col("neighbor").alias("upper"), "edge_id")
    return steps.join(near, "lower").join(far, "upper").filter("d1 = d0 + 1").join(edges.select("edge_id", "relation", "confidence"), "edge_id")


def build_side(side: str, max_hops: int, seeds: DataFrame, edges: DataFrame, mode: str) -> Side:
    steps = adjacency(edges, mode, side)
    distances = materialize(bfs(seeds, steps, max_hops), "layer-distances")
    parents = bfs_parents(distances, steps)
    layer = lambda d: F.concat(F.lit(f"{side}_d"), d.cast("string"))
    real = distances.select(node_id(side, F.col("depth"), F.col("node")).alias("node_id"), F.col("node").alias("entity_id"), "depth", layer(F.col("depth")).alias("layer"), F.lit("kg_entity").alias("node_type"), F.lit(side).alias("side"))
    dead_ends = distances.filter(F.col("depth") < max_hops).join(parents.select(F.col("parent").alias("node")).distinct(), "node", "left_anti")
    chain = dead_ends.withColumn("at", F.explode(F.sequence(F.col("depth") + 1, F.lit(max_hops))))
    carry = chain.select(carry_id(side, F.col("at"), F.col("node")).alias("node_id"), F.col("node").alias("entity_id"), F.col("at").alias("depth"), layer(F.col("at")).alias("layer"), F.lit("structural_carry").alias("node_type"), F.lit(side).alias("side"))
    joined = oriented(edges, distances, side, mode)
    merged = joined.groupBy(node_id(side, F.col("d0"), F.col("lower")).alias("near"), node_id(side, F.col("d1"), F.col("upper")).alias("far")).agg(
        piped(F.col("relation")).alias("relation_types"), piped(F.col("edge_id")).alias("relation_ids"), F.max("confidence").alias("confidence"), F.lit("kg_edge").alias("edge_kind")
    )
    before = F.when(F.col("at") == F.col("depth") + 1, node_id(side, F.col("depth"), F.col("node"))).otherwise(carry_id(side, F.col("at") - 1, F.col("node")))
    carried = chain.select(before.alias("near"), carry_id(side, F.col("at"), F.col("node")).alias("far"), F.lit("structural_carry").alias("relation_types"), F.lit("").alias("relation_ids"), F.lit(1.0).alias("confidence"), F.lit("carry_edge").alias("edge_kind"))
    both = merged.unionByName(carried)
    ends = ("near", "far") if side == "source" else ("far", "near")
    flowing = both.select(F.col(ends[0]).alias("source_node"), F.col(ends[1]).alias("target_node"), "relation_types", "relation_ids", "confidence", "edge_kind")
    depth_of = distances.select(F.col("node").alias("parent"), F.col("depth").alias("pd"))
    heard = parents.join(depth_of, "parent").groupBy("node").agg(piped(node_id(side, F.col("pd"), F.col("parent"))).alias("parent_node_ids"), piped(F.col("edge_id")).alias("parent_relation_ids"))
    occurrences = distances.join(heard, "node", "left").select(F.lit(side).alias("side"), node_id(side, F.col("depth"), F.col("node")).alias("node_id"), F.col("node").alias("entity_id"), "depth", (F.col("depth") == 0).alias("is_seed"), F.lit(False).alias("is_carry"), F.coalesce("parent_node_ids", F.lit("")).alias("parent_node_ids"), F.coalesce("parent_relation_ids", F.lit("")).alias("parent_relation_ids"))
    held = chain.select(F.lit(side).alias("side"), carry_id(side, F.col("at"), F.col("node")).alias("node_id"), F.col("node").alias("entity_id"), F.col("at").alias("depth"), F.lit(False).alias("is_seed"), F.lit(True).alias("is_carry"), before.alias("parent_node_ids"), F.lit("").alias("parent_relation_ids"))
    return Side(distances, real.unionByName(carry), flowing, occurrences.unionByName(held))


def rejected_edges(side: str, max_hops: int, distances: DataFrame, edges: DataFrame, mode: str) -> DataFrame:
    """Why an edge at the searched region is not part of a side; edges out of reach are not listed."""
    at = lambda c, d: distances.select(F.col("node").alias(c), F.col("depth").alias(d))
    j = edges.join(at("source", "sd"), "source", "left").join(at("target", "td"), "target", "left")
    sd, td = F.col("sd"), F.col("td")
    refused = F.lit(False) if mode == "undirected" else ((td < sd) if side == "source" else (sd < td))
    if mode == "undirected":
        edge_of_reach = (F.coalesce(sd, td) == max_hops) & (sd.isNull() | td.isNull())
    else:
        inner, outer = (sd, td) if side == "source" else (td, sd)
        edge_of_reach = (inner == max_hops) & outer.isNull()
    both = sd.isNotNull() & td.isNotNull()
    reason = (
        F.when((F.col("source") == F.col("target")) & sd.isNotNull(), "self_loop")
        .when(both & (sd == td), "same_layer")
        .when(both & (F.abs(sd - td) > 1), "depth_gap")
        .when(both & refused, "backward")
        .when(~both & edge_of_reach, "outside_hop_limit")
    )
    return j.select(F.lit(side).alias("side"), "source", "target", "edge_id", F.col("sd").alias("source_depth"), F.col("td").alias("target_depth"), reason.alias("reason")).filter("reason is not null")


@dataclass
class Network:
    nodes: DataFrame
    edges: DataFrame
    occurrences: DataFrame
    rejected: DataFrame

    def widths(self) -> DataFrame:
        return self.nodes.groupBy("side", "depth", "layer").agg(F.count("*").alias("width"), F.countDistinct("entity_id").alias("entities"))


def layers(source_hops: int, target_hops: int) -> list[str]:
    return [f"source_d{i}" for i in range(source_hops + 1)] + [f"target_d{i}" for i in range(target_hops, -1, -1)]


def build_network(edges: DataFrame, source_seeds: DataFrame, target_seeds: DataFrame, source_hops: int, target_hops: int, mode: str = "undirected", max_bridge_edges: int = 500_000, max_nodes: int = 100_000, max_edges: int = 1_000_000) -> Network:
    """Both sides and the bridge; the sizes are checked before the bridge is joined."""
    for name, seeds in (("source", source_seeds), ("target", target_seeds)):
        if seeds.isEmpty():
            raise BuildError(f"no {name} seed matches")
    left = build_side("source", source_hops, source_seeds, edges, mode)
    right = build_side("target", target_hops, target_seeds, edges, mode)
    nodes = materialize(left.nodes.unionByName(right.nodes), "layer-nodes")
    ends = {r.side: r["count"] for r in nodes.filter(((F.col("side") == "source") & (F.col("depth") == source_hops)) | ((F.col("side") == "target") & (F.col("depth") == target_hops))).groupBy("side").count().collect()}
    bridges = ends.get("source", 0) * ends.get("target", 0)
    if bridges > max_bridge_edges:
        raise BuildError(f"{bridges} bridge edges exceed {max_bridge_edges}")
    out = nodes.filter((F.col("side") == "source") & (F.col("depth") == source_hops)).select(F.col("node_id").alias("source_node"))
    into = nodes.filter((F.col("side") == "target") & (F.col("depth") == target_hops)).select(F.col("node_id").alias("target_node"))
    bridge = out.crossJoin(into).select("source_node", "target_node", F.lit("frontier_bridge").alias("relation_types"), F.lit("").alias("relation_ids"), F.lit(1.0).alias("confidence"), F.lit("bridge_edge").alias("edge_kind"))
    kept = materialize(left.edges.unionByName(right.edges).unionByName(bridge), "layer-edges")
    if nodes.count() > max_nodes or kept.count() > max_edges:
        raise BuildError("the network exceeds its limits")
    rejected = rejected_edges("source", source_hops, left.distances, edges, mode).unionByName(rejected_edges("target", target_hops, right.distances, edges, mode))
    return Network(nodes, kept, left.occurrences.unionByName(right.occurrences), rejected)


def violations(network: Network, source_hops: int, target_hops: int) -> dict[str, int]:
    """Counts that must all be zero in a valid network."""
    nodes, edges = network.nodes, network.edges
    order = F.when(F.col("side") == "source", F.col("depth")).otherwise(source_hops + 1 + target_hops - F.col("depth"))
    placed = nodes.select("node_id", order.alias("at"))
    j = edges.join(placed.select(F.col("node_id").alias("source_node"), F.col("at").alias("a")), "source_node", "left").join(placed.select(F.col("node_id").alias("target_node"), F.col("at").alias("b")), "target_node", "left")
    found = j.agg(
        F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("dangling_edges"),
        F.count_if(F.col("b") != F.col("a") + 1).alias("skipping_edges"),
        F.count_if((F.col("edge_kind") == "kg_edge") & (F.col("relation_ids") == "")).alias("edges_without_evidence"),
    ).first()
    last = source_hops + 1 + target_hops
    stuck = placed.filter(F.col("at") < last).join(edges.select(F.col("source_node").alias("node_id")), "node_id", "left_anti").count()
    return {
        "repeated_nodes": nodes.groupBy("node_id").count().filter("count > 1").count(),
        "empty_layers": last + 1 - placed.select("at").distinct().count(),
        "dead_ends": stuck,
        **found.asDict(),
    }
