"""Bounded corridors: every walk of at most ``hops`` steps from a source seed to a target seed.

Entities whose two distances add up to at most ``hops`` form the corridor.  Its arcs are unrolled over
the steps into a layered DAG of states, states off complete walks are pruned, and budgets cut what
remains while a protected backbone stays connected.

``edges`` are ``(edge_id, source, target, relation, confidence)``.  All loops run ``hops`` times.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.hashing import percent_encoded
from lodestone.operators.graph import adjacency, bfs
from lodestone.operators.layered import BuildError, piped
from lodestone.session import materialize

PROGRESS, LATERAL, CARRY = "kg_progress", "kg_lateral", "terminal_carry"


@dataclass(frozen=True)
class Limits:
    unique_entities: int = 5_000
    occurrences: int = 20_000
    entities_per_layer: int = 2_000
    edges_per_node: int = 64
    edges: int = 200_000
    keep_all_progress: bool = True
    allow_lateral: bool = False
    max_lateral: int = 1
    overflow: str = "prune"


@dataclass
class Corridor:
    members: DataFrame
    scores: DataFrame
    selected: DataFrame
    arcs: DataFrame
    states: DataFrame
    edges: DataFrame
    rejected: DataFrame
    stats: dict[str, int] = field(default_factory=dict)

    @property
    def search_complete(self) -> bool:
        return not any(v for k, v in self.stats.items() if k.endswith("_pruned"))


def membership(edges: DataFrame, source_seeds: DataFrame, target_seeds: DataFrame, hops: int, mode: str = "undirected") -> DataFrame:
    """``(node, ds, dt)`` of the corridor."""
    ds = bfs(source_seeds, adjacency(edges, mode, "source"), hops).withColumnRenamed("depth", "ds")
    dt = bfs(target_seeds, adjacency(edges, mode, "target"), hops).withColumnRenamed("depth", "dt")
    return ds.join(dt, "node").filter(F.col("ds") + F.col("dt") <= hops)


def entity_scores(members: DataFrame, edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """``(node, score)``: neighbours inside the corridor, keyword hit, mean confidence, distance."""
    inside = members.select("node")
    kept = edges.filter("source <> target").join(inside.withColumnRenamed("node", "source"), "source", "left_semi").join(inside.withColumnRenamed("node", "target"), "target", "left_semi")
    ends = kept.select(F.col("source").alias("node"), F.col("target").alias("other"), "confidence").unionByName(kept.select(F.col("target").alias("node"), F.col("source").alias("other"), "confidence"))
    facts = ends.groupBy("node").agg(F.countDistinct("other").alias("degree"), F.avg("confidence").alias("mean"))
    hit = seeds.select(F.col(seeds.columns[0]).alias("node")).distinct().withColumn("hit", F.lit(1.0))
    score = F.log1p(F.coalesce("degree", F.lit(0))) + F.coalesce("hit", F.lit(0.0)) + 0.25 * F.coalesce("mean", F.lit(0.0)) - 0.05 * (F.col("ds") + F.col("dt"))
    return members.join(facts, "node", "left").join(hit, "node", "left").select("node", score.alias("score"))


def backbone(members: DataFrame, edges: DataFrame, source_seeds: DataFrame, target_seeds: DataFrame, hops: int, mode: str) -> DataFrame:
    """``node``: seeds in the corridor and one shortest walk from each source seed."""
    dt = members.select("node", "dt")
    near = dt.select(F.col("node").alias("neighbor"), F.col("dt").alias("next_dt"))
    steps = adjacency(edges, mode, "source").join(dt, "node").join(near, "neighbor").filter("next_dt = dt - 1")
    following = materialize(steps.groupBy("node").agg(F.min(F.struct("neighbor", "edge_id")).alias("m")).select("node", F.col("m.neighbor").alias("neighbor")), "backbone")
    at = dt.join(source_seeds.select(F.col(source_seeds.columns[0]).alias("node")).distinct(), "node", "left_semi").select("node")
    kept = at.unionByName(dt.join(target_seeds.select(F.col(target_seeds.columns[0]).alias("node")).distinct(), "node", "left_semi").select("node"))
    for _ in range(hops):
        at = materialize(at.join(following, "node").select(F.col("neighbor").alias("node")).distinct(), "backbone")
        kept = kept.unionByName(at)
    return kept.distinct()


def select_entities(members: DataFrame, scores: DataFrame, protected: DataFrame, limits: Limits) -> DataFrame:
    n = members.count()
    if n <= limits.unique_entities:
        return members
    if limits.overflow == "fail":
        raise BuildError(f"{n} corridor entities exceed {limits.unique_entities}")
    if (p := protected.count()) > limits.unique_entities:
        raise BuildError(f"{p} protected entities exceed {limits.unique_entities}")
    ranked = members.join(scores, "node").join(protected.withColumn("safe", F.lit(1)), "node", "left")
    return ranked.orderBy(F.col("safe").desc_nulls_last(), F.desc("score"), "node").limit(limits.unique_entities).select(*members.columns)


def build_arcs(selected: DataFrame, edges: DataFrame, mode: str, limits: Limits) -> tuple[DataFrame, DataFrame]:
    """Arcs kept per source entity, and the ``(source, target)`` that the cap cut."""
    both = [edges.select("source", "target", "edge_id", "relation", "confidence", F.lit("forward").alias("traversal"))]
    if mode == "undirected":
        both.append(edges.filter("source <> target").select(F.col("target").alias("source"), F.col("source").alias("target"), "edge_id", "relation", "confidence", F.lit("reverse").alias("traversal")))
    steps = both[0] if len(both) == 1 else both[0].unionByName(both[1])
    far = lambda c, d: selected.select(F.col("node").alias(c), F.col("dt").alias(d))
    s, t = F.col("s_dt"), F.col("t_dt")
    lateral = (s == t) & (F.col("source") != F.col("target")) & F.lit(limits.allow_lateral)
    if mode == "undirected":
        lateral = lateral & (F.col("source") < F.col("target"))
    kind = F.when(t == s - 1, PROGRESS).when(lateral, LATERAL)
    joined = steps.join(far("source", "s_dt"), "source").join(far("target", "t_dt"), "target").withColumn("kind", kind).filter("kind is not null")
    arcs = joined.groupBy("source", "target", "kind").agg(
        piped(F.col("relation")).alias("relation_types"), piped(F.col("edge_id")).alias("relation_ids"), piped(F.col("traversal")).alias("traversals"), F.max("confidence").alias("confidence"), F.max("t_dt").alias("t_dt")
    )
    order = Window.partitionBy("source").orderBy(F.when(F.col("kind") == PROGRESS, 0).otherwise(1), "target", "relation_ids")
    keep = F.row_number().over(order) <= limits.edges_per_node
    if limits.keep_all_progress:
        keep = keep | (F.col("kind") == PROGRESS)
    marked = arcs.withColumn("keep", keep)
    return marked.filter("keep").drop("keep"), marked.filter("not keep").select("source", "target")


def state_id(step: Column, lateral: Column, kind: Column, entity: Column) -> Column:
    three = lambda c: F.lpad(c.cast("string"), 3, "0")
    tail = F.when(kind == "carry", F.concat(F.lit("carry::"), F.substring(F.sha2(entity, 256), 1, 16))).otherwise(percent_encoded(entity))
    return F.concat(F.lit("step::d"), three(step), F.lit("::lat"), three(lateral), F.lit("::"), tail)


_STATE = ("step", "entity", "lateral", "kind")


def expand(source_seeds: DataFrame, target_seeds: DataFrame, selected: DataFrame, arcs: DataFrame, hops: int, limits: Limits) -> tuple[DataFrame, DataFrame]:
    """States and moves between them over ``hops`` steps; a target absorbs into carries."""
    terminal = selected.join(target_seeds.select(F.col(target_seeds.columns[0]).alias("node")).distinct(), "node", "left_semi").select(F.col("node").alias("entity"), F.lit(True).alias("ends"))
    start = selected.join(source_seeds.select(F.col(source_seeds.columns[0]).alias("node")).distinct(), "node", "left_semi")
    layer = materialize(start.select(F.lit(0).alias("step"), F.col("node").alias("entity"), F.lit(0).alias("lateral"), F.lit("entity").alias("kind")), "corridor-states")
    states, moves = layer, None
    for step in range(hops):
        judged = layer.join(terminal, "entity", "left").withColumn("stays", F.coalesce("ends", F.lit(False)) | (F.col("kind") == "carry"))
        here = [F.col(c).alias(f"from_{c}") for c in _STATE]
        held = judged.filter("stays").select(*here, F.lit(step + 1).alias("step"), "entity", "lateral", F.lit("carry").alias("kind"), F.lit(CARRY).alias("edge_kind"), F.lit("").alias("relation_types"), F.lit("").alias("relation_ids"), F.lit(1.0).alias("confidence"))
        gone = judged.filter(~F.col("stays")).join(arcs.withColumnRenamed("kind", "arc"), judged.entity == arcs.source)
        spent = F.col("lateral") + (F.col("arc") == LATERAL).cast("int")
        gone = gone.withColumn("spent", spent).filter((F.col("spent") <= limits.max_lateral) & (F.col("t_dt") + step + 1 <= hops))
        gone = gone.select(*here, F.lit(step + 1).alias("step"), F.col("target").alias("entity"), F.col("spent").alias("lateral"), F.lit("entity").alias("kind"), F.col("arc").alias("edge_kind"), "relation_types", "relation_ids", "confidence")
        stepped = materialize(held.unionByName(gone), "corridor-moves")
        moves = stepped if moves is None else moves.unionByName(stepped)
        layer = stepped.select(*_STATE).distinct()
        states = states.unionByName(layer)
    name = lambda p: state_id(F.col(f"{p}step"), F.col(f"{p}lateral"), F.col(f"{p}kind"), F.col(f"{p}entity"))
    nodes = states.select(name("").alias("node_id"), *_STATE)
    links = moves.select(name("from_").alias("source_node"), name("").alias("target_node"), F.col("from_step").alias("step"), "edge_kind", "relation_types", "relation_ids", "confidence")
    return materialize(nodes, "corridor-nodes"), materialize(links, "corridor-links")


def complete_walks(nodes: DataFrame, links: DataFrame, targets: DataFrame, hops: int) -> tuple[DataFrame, DataFrame]:
    """Only states on a walk from step 0 to a target at the last step, and their moves."""
    final = nodes.filter(F.col("step") == hops).join(targets.select(F.col(targets.columns[0]).alias("entity")).distinct(), "entity", "left_semi").select("node_id")
    alive, back = final, []
    for step in range(hops - 1, -1, -1):
        kept = materialize(links.filter(F.col("step") == step).join(alive.withColumnRenamed("node_id", "target_node"), "target_node", "left_semi"), "corridor-back")
        back.append(kept)
        alive = kept.select(F.col("source_node").alias("node_id")).distinct()
    seen, ahead, live = alive, alive, None
    for kept in reversed(back):
        walked = materialize(kept.join(ahead.withColumnRenamed("node_id", "source_node"), "source_node", "left_semi"), "corridor-ahead")
        live = walked if live is None else live.unionByName(walked.select(*live.columns))
        ahead = walked.select(F.col("target_node").alias("node_id")).distinct()
        seen = seen.unionByName(ahead)
    if live is None:
        return nodes.join(final, "node_id", "left_semi"), links
    return materialize(nodes.join(seen.distinct(), "node_id", "left_semi"), "corridor-nodes"), materialize(live.select(*links.columns), "corridor-links")


def protected_walks(nodes: DataFrame, links: DataFrame, hops: int) -> tuple[DataFrame, DataFrame]:
    """One walk onward from every start and one back from every end: ``node_id`` and move pairs."""
    rank = F.when(F.col("edge_kind") == PROGRESS, 0).when(F.col("edge_kind") == LATERAL, 1).otherwise(2)
    onward = links.groupBy("source_node").agg(F.min(F.struct(rank.alias("r"), "target_node")).alias("m")).select("source_node", F.col("m.target_node").alias("target_node"))
    backward = links.groupBy("target_node").agg(F.min("source_node").alias("source_node"))
    onward, backward = materialize(onward, "corridor-onward"), materialize(backward, "corridor-backward")
    pairs = None
    for table, here, there, first in ((onward, "source_node", "target_node", 0), (backward, "target_node", "source_node", hops)):
        at = nodes.filter(F.col("step") == first).select(F.col("node_id").alias(here))
        for _ in range(hops):
            moved = materialize(table.join(at, here, "left_semi").select("source_node", "target_node"), "corridor-protected")
            pairs = moved if pairs is None else pairs.unionByName(moved)
            at = moved.select(F.col(there).alias(here)).distinct()
    pairs = pairs.distinct()
    ends = nodes.filter((F.col("step") == 0) | (F.col("step") == hops)).select("node_id")
    return ends.unionByName(pairs.select(F.col("source_node").alias("node_id"))).unionByName(pairs.select(F.col("target_node").alias("node_id"))).distinct(), pairs


def apply_occurrence_budget(nodes: DataFrame, links: DataFrame, safe: DataFrame, scores: DataFrame, targets: DataFrame, hops: int, limits: Limits) -> tuple[DataFrame, DataFrame]:
    """Caps distinct entities per layer, then all states, protected ones first; re-prunes after."""
    marked = nodes.join(safe.withColumn("safe", F.lit(1)), "node_id", "left").join(scores.withColumnRenamed("node", "entity"), "entity", "left").fillna({"safe": 0, "score": 0.0})
    anchors = marked.groupBy("step", "entity").agg(F.max("safe").alias("safe"), F.max("score").alias("score"))
    over = anchors.groupBy("step").agg(F.count("*").alias("n"), F.sum("safe").alias("p")).filter(F.col("n") > limits.entities_per_layer)
    worst = over.agg(F.count("*").alias("n"), F.max("p").alias("p")).first()
    total = nodes.count()
    if not worst.n and total <= limits.occurrences:
        return nodes, links
    if limits.overflow == "fail":
        raise BuildError("the expanded corridor exceeds its layer or state budget")
    if worst.n and worst.p > limits.entities_per_layer:
        raise BuildError("protected entities of a layer exceed its budget")
    by_layer = Window.partitionBy("step").orderBy(F.desc("safe"), F.desc("score"), "entity")
    kept_anchors = anchors.withColumn("r", F.row_number().over(by_layer)).filter(F.col("r") <= limits.entities_per_layer).select("step", "entity")
    kept = materialize(marked.join(kept_anchors, ["step", "entity"], "left_semi"), "corridor-budget")
    if kept.count() > limits.occurrences:
        if safe.count() > limits.occurrences:
            raise BuildError("protected states exceed the state budget")
        kept = kept.orderBy(F.desc("safe"), F.when(F.col("kind") == "carry", 0).otherwise(1), F.desc("score"), "lateral", "node_id").limit(limits.occurrences)
    kept = kept.select(*nodes.columns)
    ids = kept.select("node_id")
    linked = links.join(ids.withColumnRenamed("node_id", "source_node"), "source_node", "left_semi").join(ids.withColumnRenamed("node_id", "target_node"), "target_node", "left_semi")
    return complete_walks(kept, linked.select(*links.columns), targets, hops)


def apply_edge_budget(nodes: DataFrame, links: DataFrame, pairs: DataFrame, targets: DataFrame, hops: int, limits: Limits) -> tuple[DataFrame, DataFrame]:
    if (n := links.count()) <= limits.edges:
        return nodes, links
    if limits.overflow == "fail":
        raise BuildError(f"{n} edges exceed {limits.edges}")
    marked = links.join(pairs.withColumn("safe", F.lit(1)), ["source_node", "target_node"], "left").fillna({"safe": 0})
    if (p := marked.filter("safe = 1").count()) > limits.edges:
        raise BuildError(f"{p} protected edges exceed {limits.edges}")
    kind = F.when(F.col("edge_kind") == CARRY, 0).when(F.col("edge_kind") == PROGRESS, 1).otherwise(2)
    kept = marked.orderBy(F.desc("safe"), kind, "source_node", "target_node").limit(limits.edges).select(*links.columns)
    return complete_walks(nodes, kept, targets, hops)


def rejected(edges: DataFrame, members: DataFrame, selected: DataFrame, capped: DataFrame, mode: str, limits: Limits) -> DataFrame:
    at = lambda c, p: members.select(F.col("node").alias(c), F.col("ds").alias(f"{p}_ds"), F.col("dt").alias(f"{p}_dt"))
    chosen = lambda c, p: selected.select(F.col("node").alias(c), F.lit(True).alias(f"{p}_in"))
    cut = capped.select(F.least("source", "target").alias("lo"), F.greatest("source", "target").alias("hi"), F.lit(True).alias("cut")).distinct()
    j = edges.join(at("source", "s"), "source", "left").join(at("target", "t"), "target", "left").join(chosen("source", "s"), "source", "left").join(chosen("target", "t"), "target", "left")
    j = j.withColumn("lo", F.least("source", "target")).withColumn("hi", F.greatest("source", "target")).join(cut, ["lo", "hi"], "left")
    s, t = F.col("s_dt"), F.col("t_dt")
    reason = F.when(s.isNull() | t.isNull(), "outside_bounded_corridor").when(F.col("s_in").isNull() | F.col("t_in").isNull(), "entity_budget_pruned").when(F.col("cut"), "edge_per_node_pruned")
    if mode == "directed":
        reason = reason.when(t > s, "backward")
    if not limits.allow_lateral:
        reason = reason.when(s == t, "lateral_disabled")
    return j.select("source", "target", "edge_id", F.col("s_ds").alias("source_depth"), F.col("t_dt").alias("target_depth"), reason.alias("reason")).filter("reason is not null")


def build_corridor(edges: DataFrame, source_seeds: DataFrame, target_seeds: DataFrame, hops: int, mode: str = "undirected", limits: Limits = Limits()) -> Corridor:
    members = materialize(membership(edges, source_seeds, target_seeds, hops, mode), "corridor-members")
    seeds = source_seeds.select(F.col(source_seeds.columns[0]).alias("node")).unionByName(target_seeds.select(F.col(target_seeds.columns[0]).alias("node")))
    if members.isEmpty():
        raise BuildError(f"no walk of at most {hops} hops joins the seeds")
    scores = materialize(entity_scores(members, edges, seeds), "corridor-scores")
    protected = materialize(backbone(members, edges, source_seeds, target_seeds, hops, mode), "corridor-backbone")
    selected = materialize(select_entities(members, scores, protected, limits), "corridor-selected")
    arcs, capped = build_arcs(selected, edges, mode, limits)
    arcs, capped = materialize(arcs, "corridor-arcs"), materialize(capped, "corridor-capped")
    nodes, links = expand(source_seeds, target_seeds, selected, arcs, hops, limits)
    nodes, links = complete_walks(nodes, links, target_seeds, hops)
    if nodes.isEmpty():
        raise BuildError("no complete walk is left after expansion")
    safe, pairs = protected_walks(nodes, links, hops)
    safe, pairs = materialize(safe, "corridor-safe"), materialize(pairs, "corridor-pairs")
    before = nodes.count()
    nodes, links = apply_occurrence_budget(nodes, links, safe, scores, target_seeds, hops, limits)
    after, linked = nodes.count(), links.count()
    nodes, links = apply_edge_budget(nodes, links, pairs, target_seeds, hops, limits)
    stats = {
        "candidate_entities": members.count(),
        "entities_pruned": members.count() - selected.count(),
        "arcs_pruned": capped.count(),
        "occurrences_pruned": before - after,
        "edges_pruned": linked - links.count(),
        "occurrences": nodes.count(),
    }
    return Corridor(members, scores, selected, arcs, nodes, links, rejected(edges, members, selected, capped, mode, limits), stats)


def violations(corridor: Corridor, source_seeds: DataFrame, target_seeds: DataFrame, hops: int, limits: Limits = Limits()) -> dict[str, int]:
    """Counts that must all be zero in a valid corridor."""
    nodes, links = corridor.states, corridor.edges
    dt = corridor.selected.select(F.col("node").alias("entity"), "dt")
    placed = nodes.join(dt, "entity", "left")
    ends = lambda d, c: d.select(F.col(d.columns[0]).alias(c)).distinct()
    s = placed.select(F.col("node_id").alias("source_node"), F.col("step").alias("s_step"), F.col("lateral").alias("s_lat"), F.col("dt").alias("s_dt"))
    t = placed.select(F.col("node_id").alias("target_node"), F.col("step").alias("t_step"), F.col("lateral").alias("t_lat"), F.col("dt").alias("t_dt"))
    j = links.join(s, "source_node", "left").join(t, "target_node", "left")
    lateral = (F.col("edge_kind") == LATERAL).cast("int")
    found = j.agg(
        F.count_if(F.col("s_step").isNull() | F.col("t_step").isNull()).alias("dangling_edges"),
        F.count_if(F.col("t_step") != F.col("s_step") + 1).alias("skipping_edges"),
        F.count_if((F.col("edge_kind") == PROGRESS) & (F.col("t_dt") != F.col("s_dt") - 1)).alias("progress_without_progress"),
        F.count_if(F.col("t_lat") != F.col("s_lat") + lateral).alias("lateral_miscounted"),
    ).first()
    return {
        "repeated_states": nodes.groupBy("node_id").count().filter("count > 1").count(),
        "outside_budget": placed.filter((F.col("lateral") > limits.max_lateral) | ((F.col("kind") == "entity") & (F.col("step") + F.col("dt") > hops))).count(),
        "foreign_starts": nodes.filter("step = 0").join(ends(source_seeds, "entity"), "entity", "left_anti").count(),
        "foreign_ends": nodes.filter(F.col("step") == hops).join(ends(target_seeds, "entity"), "entity", "left_anti").count(),
        "dead_ends": nodes.filter(F.col("step") < hops).join(links.select(F.col("source_node").alias("node_id")), "node_id", "left_anti").count(),
        "without_origin": nodes.filter("step > 0").join(links.select(F.col("target_node").alias("node_id")), "node_id", "left_anti").count(),
        **found.asDict(),
    }
