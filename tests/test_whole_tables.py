"""Queries whose SQL counterpart still reads a part of its table are held against brute force over all rows."""

import hashlib
import random
from collections import defaultdict

import pytest

import __spark_entry__

QUERIES = __spark_entry__.queries()


def items(n=160):
    """Line items of three separate groups of suppliers; few quantities reach 50."""
    rng = random.Random(4)
    out = []
    for i in range(n):
        group = i % 3
        out.append((i // 4, rng.randint(1, 12) + 20 * group, rng.randint(1, 4) + 10 * group, float(rng.randint(1, 50)), round(rng.randint(0, 10) / 100, 2), rng.choice("ANR")))
    return out


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("whole"))
    spark.createDataFrame(items(), "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_discount double, l_returnflag string").write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(0, "R")], "r_regionkey long, r_name string").write.parquet(f"{path}/region.parquet")
    turns = [(c, t, ("user", "assistant")[t % 2], f" text {c} {t} ") for c in range(7) for t in range(c % 3 + 1)]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{path}/conversations.parquet")
    return path


def edges():
    return {(f"S{s}", f"P{p}", flag) for _, p, s, _, _, flag in items()}


def distances(start, hops):
    near = defaultdict(set)
    for s, p, _ in edges():
        near[s].add(p)
        near[p].add(s)
    found, at = {start: 0}, {start}
    for h in range(1, hops + 1):
        at = {b for a in at for b in near[a]} - set(found)
        found |= dict.fromkeys(at, h)
    return found


def test_searches_walk_all_line_items(spark, data):
    got = {r.node: r.depth for r in QUERIES["bfs_distances"](spark, data).collect()}
    assert got == distances("S1", 4) and len(got) > 10
    depth = distances("S1", 3)
    want = {(b, a, f"{s}:{p}:{f}") for s, p, f in edges() for a, b in ((s, p), (p, s)) if a in depth and b in depth and depth[b] == depth[a] + 1}
    assert {tuple(r) for r in QUERIES["bfs_parents"](spark, data).select("node", "parent", "edge_id").collect()} == want


def test_components_and_quality_cover_all_line_items(spark, data):
    nodes = {n for s, p, _ in edges() for n in (s, p)}
    want = {n: min(distances(n, len(nodes))) for n in nodes}
    assert {r.node: r.root for r in QUERIES["components"](spark, data).collect()} == want
    orders = defaultdict(set)
    for o, p, *_ in items():
        orders[p].add(o)
    got = QUERIES["graph_quality"](spark, data).first()
    largest = max(list(want.values()).count(r) for r in set(want.values()))
    assert (got.compression, got.largest_component_ratio) == pytest.approx((len(items()) / len(nodes), largest / len(nodes)), abs=1e-4)
    assert got.reuse_ratio == pytest.approx(sum(len(x) > 1 for x in orders.values()) / len(nodes), abs=1e-4)
    assert got.duplicate_ratio == pytest.approx((len(items()) - len(edges())) / len(items()), abs=1e-4)


def test_corridor_network_cuts_nothing(spark, data):
    from lodestone.operators import corridor
    from lodestone.plans import lens, queries

    wide = corridor.Limits(10**6, 10**7, 10**6, edges=10**7)
    built = corridor.build_corridor(lens.sparse_edges(spark, data), queries._seeds(spark, data, *queries._ODD), queries._seeds(spark, data, *queries._EVEN), 4, limits=wide)
    assert not any(v for k, v in built.stats.items() if k.endswith("_pruned"))
    assert sorted(map(tuple, QUERIES["corridor_network"](spark, data).collect())) == sorted(map(tuple, built.edges.collect()))


def test_every_conversation_is_stacked(spark, data):
    got = {r.conv_id: r.stacked for r in QUERIES["stack_sections"](spark, data).collect()}
    want = {}
    for c in range(7):
        parts = [f"[WORK {t}]\nTitle: {('user', 'assistant')[t % 2]}\nDOI: \ntext {c} {t}\n[/WORK {t}]" for t in range(c % 3 + 1)]
        want[c] = hashlib.sha256("\n\n".join(parts).encode()).hexdigest()
    assert got == want


def test_every_row_of_a_document_is_restored(spark, tmp_path):
    """Rows without letters or text, and rows that share an id, come back as in the SQL, one by one."""
    rows = [(1, "b a,b  c a"), (1, "x y x"), (2, "123 --"), (3, ""), (4, None), (5, "one")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, QUERIES["restore_abstract"](spark, str(tmp_path)).collect()), key=str)
    assert got == sorted([(1, "b a b c a"), (1, "x y x"), (2, ""), (3, ""), (4, None), (5, "one")], key=str)


def test_passages_are_found_in_long_documents_in_one_reading(spark, tmp_path):
    """A text of 30,000 words is split once, not once per run of words."""
    import time

    words = " ".join(f"w{i % 997}x{i % 31}" for i in range(30_000))
    spark.createDataFrame([(1, words), (2, "w0x0 " + words), (3, None)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, words[-200:]), (8, "not in any of the texts at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    began = time.perf_counter()
    got = {r.item_id: (r.documents, r.first_offset, r.validated) for r in QUERIES["evidence_validated"](spark, str(tmp_path)).collect()}
    assert got == {7: (2, words.find(words[-200:]), True), 8: (0, None, False)}
    assert time.perf_counter() - began < 60
