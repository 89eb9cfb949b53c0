"""Steps whose work must not grow faster than the input, held by their plans and by what they hand on."""

import random

import pyarrow as pa

from lodestone.operators import graph, resolve


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_forms_that_meet_nothing_stay_out_of_python(spark):
    rows = [("G", f"Part {i}", i) for i in range(300)] + [("G", "heart failure", 300), ("G", "failure of heart", 301), ("G", "failure heart", 302)]
    known = spark.createDataFrame([("G", "E1", "known form"), ("G", "E2", "Part 7")], "entity_type string, entity_id string, form string")
    found = resolve.resolve(spark.createDataFrame(rows, "entity_type string, mention string, first_seen long"), known)
    assert "FlatMapGroupsInPandas" not in plan(found)
    got = {r.mention: (r.entity_id, r.method) for r in found.collect()}
    assert len(got) == 303 and got["Part 7"] == ("E2", "exact_alias") and got["Part 8"][1] == "new_entity"
    assert got["failure heart"] == (got["heart failure"][0], "token_set") and got["failure of heart"][1] == "new_entity"


def test_links_are_reduced_before_they_are_shuffled(spark):
    rng = random.Random(5)
    links = [(f"S{rng.randint(0, 20)}", f"P{rng.randint(0, 90)}é") for _ in range(5000)] + [(f"c{i}", f"c{i + 1}") for i in range(50)]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*links)], ["a", "b"])
    stars = [(u, v) for b in graph._stars(iter([batch.slice(0, 2000), batch.slice(2000)])) for u, v in zip(*map(pa.Array.to_pylist, b.columns))]
    nodes = {n for x in links for n in x}
    least = {n: n for n in nodes}
    for _ in nodes:
        new = dict(least)
        for a, b in links:
            new[a] = new[b] = min(new[a], new[b])
        if new == least:
            break
        least = new
    assert dict(stars) == {n: r for n, r in least.items() if n != r} and len(stars) == len(dict(stars))
    got = graph.connected_components(spark.createDataFrame([*links, ("x", "x")], "a string, b string"))
    assert {tuple(r) for r in got.filter("node <> root").collect()} == set(stars)


def test_a_search_does_not_shuffle_all_steps_per_hop(spark, monkeypatch):
    plans, write = [], graph.materialize
    monkeypatch.setattr(graph, "materialize", lambda df, label: plans.append(plan(df)) or write(df, label))
    steps = spark.createDataFrame([("a", "b", "1"), ("a", "b", "2"), ("b", "c", "3"), ("b", "b", "4"), ("c", "d", "5")], "node string, neighbor string, edge_id string")
    found = graph.bfs(spark.createDataFrame([("a",)], "node string"), steps, 2)
    assert sorted(map(tuple, found.collect())) == [("a", 0), ("b", 1), ("c", 2)]
    assert len(plans) == 3 and all(p.count("Aggregate") == 1 for p in plans[1:])


def test_support_counts_an_assertion_in_each_relation(spark, tmp_path):
    """Equal raw ids under two relations count in both, as in the SQL."""
    import __spark_entry__

    rows = [(1, 2, 3, 1, 10.0, 0.05, "A", "F"), (1, 2, 3, 1, 10.0, 0.05, "N", "O"), (1, 2, 3, 1, 10.0, 0.05, "N", "O")]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {tuple(r) for r in __spark_entry__.queries()["support_by_relation"](spark, str(tmp_path)).collect()}
    assert got == {("negatively_associated_with", 1, 1), ("upregulates", 1, 1)}
