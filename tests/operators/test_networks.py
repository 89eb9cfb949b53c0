import pytest

from lodestone.operators import corridor, layered

EDGES = [
    ("r1", "A", "B", "associated_with", 0.8), ("r1b", "A", "B", "related_to", 0.9), ("r2", "C", "B", "associated_with", 0.7),
    ("r3", "U", "T", "associated_with", 0.95), ("r4", "W", "U", "associated_with", 0.85), ("r5", "A", "X", "related_to", 0.6),
    ("r6", "B", "B", "related_to", 0.5), ("r7", "C", "W", "associated_with", 0.88),
]
ENTITIES = [
    ("A", "Heart sound", "cardiac acoustic signal"), ("B", "Intermediate B", None), ("C", "Source frontier C", None), ("X", "Auscultation finding", None),
    ("T", "Diabetes mellitus", None), ("U", "Intermediate U", None), ("W", "Target frontier W", None),
]


def edges(spark, more=()):
    return spark.createDataFrame([*EDGES, *more], "edge_id string, source string, target string, relation string, confidence double").coalesce(1)


def seeds(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "node string").coalesce(1)


def test_keywords_match_names_aliases_and_ids(spark):
    entities = spark.createDataFrame(ENTITIES, "entity_id string, display_name string, description string")
    aliases = spark.createDataFrame([("X", "cardiac auscultation")], "entity_id string, alias string")
    words = spark.createDataFrame([("Heart-Sound",), ("cardiac auscultation",), ("diabetes",), ("t",), ("missing",), ("",)], "k string")
    got = {(r.keyword, r.entity_id, r.field) for r in layered.match_entities(entities, words, aliases).collect()}
    assert ("Heart-Sound", "A", "display_name") in got and ("cardiac auscultation", "X", "alias") in got
    assert ("diabetes", "T", "display_name") in got and ("t", "T", "entity_id") in got
    assert not any(k in ("missing", "") for k, _, _ in got)


def test_bridge_undirected(spark):
    net = layered.build_network(edges(spark), seeds(spark, "A", "X"), seeds(spark, "T"), 2, 2)
    assert net.nodes.count() == 9 and net.edges.count() == 8
    kinds = {r.edge_kind: r["count"] for r in net.edges.groupBy("edge_kind").count().collect()}
    assert kinds == {"kg_edge": 4, "carry_edge": 2, "bridge_edge": 2}
    widths = {r.layer: r.width for r in net.widths().collect()}
    assert [widths[x] for x in layered.layers(2, 2)] == [2, 2, 2, 1, 1, 1]
    merged = net.edges.filter("source_node = 's::d000::A'").first()
    assert (merged.relation_ids, merged.relation_types, merged.confidence) == ("r1|r1b", "associated_with|related_to", 0.9)
    reasons = {(r.side, r.edge_id): r.reason for r in net.rejected.collect()}
    assert reasons["source", "r5"] == "same_layer" and reasons["source", "r6"] == "self_loop" and reasons["source", "r7"] == "outside_hop_limit"
    assert not any(layered.violations(net, 2, 2).values())
    with pytest.raises(layered.BuildError):
        layered.build_network(edges(spark), seeds(spark, "A", "X"), seeds(spark, "T"), 2, 2, max_bridge_edges=1)
    with pytest.raises(layered.BuildError):
        layered.build_network(edges(spark), seeds(spark, "A").filter("node = 'z'"), seeds(spark, "T"), 2, 2)


def test_bridge_directed(spark):
    net = layered.build_network(edges(spark), seeds(spark, "A", "X"), seeds(spark, "T"), 1, 1, "directed")
    ids = {r.node_id for r in net.nodes.collect()}
    assert len(ids) == 6 and net.edges.count() == 5 and net.edges.filter("edge_kind = 'bridge_edge'").count() == 2
    assert {"s::d001::B", "t::d001::U"} <= ids and "s::d001::C" not in ids


def test_corridor(spark):
    c = corridor.build_corridor(edges(spark), seeds(spark, "A"), seeds(spark, "T"), 5)
    assert c.states.count() == 6 and c.edges.count() == 5 and c.search_complete
    assert {r.edge_kind for r in c.edges.collect()} == {"kg_progress"}
    assert not any(corridor.violations(c, seeds(spark, "A"), seeds(spark, "T"), 5).values())


def test_corridor_carries_early_arrivals(spark):
    c = corridor.build_corridor(edges(spark), seeds(spark, "C"), seeds(spark, "T"), 4)
    assert c.states.count() == 5 and c.edges.count() == 4
    assert c.edges.filter("edge_kind = 'terminal_carry'").count() == 1
    assert [r.kind for r in c.states.filter("step = 4").collect()] == ["carry"]


def test_corridor_prunes_to_its_budget(spark):
    more = [("r8", "A", "D", "associated_with", 0.7), ("r9", "D", "C", "associated_with", 0.7)]
    limits = corridor.Limits(unique_entities=6)
    c = corridor.build_corridor(edges(spark, more), seeds(spark, "A"), seeds(spark, "T"), 5, limits=limits)
    assert c.stats["candidate_entities"] == 7 and c.stats["entities_pruned"] == 1 and not c.search_complete
    assert not any(corridor.violations(c, seeds(spark, "A"), seeds(spark, "T"), 5, limits).values())
    reasons = {r.edge_id: r.reason for r in c.rejected.collect()}
    assert reasons["r8"] == reasons["r9"] == "entity_budget_pruned" and reasons["r5"] == "outside_bounded_corridor"
    with pytest.raises(layered.BuildError):
        corridor.build_corridor(edges(spark, more), seeds(spark, "A"), seeds(spark, "T"), 5, limits=corridor.Limits(unique_entities=6, overflow="fail"))
    tight = corridor.Limits(occurrences=6, edges=5)
    c = corridor.build_corridor(edges(spark, more), seeds(spark, "A"), seeds(spark, "T"), 5, limits=tight)
    assert c.states.count() == 6 and c.edges.count() == 5 and c.stats["occurrences_pruned"] == 1
