import random
import re

import pytest
from pyspark.sql import functions as F

from lodestone.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def rows(n=300):
    rng = random.Random(6)
    out = []
    for i in range(n):
        source = rng.choice(["a", "a", "a", "b", "c", "d", "é", None])
        text = rng.choice([None, "", " "]) if i % 17 == 0 else " ".join(["w"] * rng.randint(1, 60)) + rng.choice(["", "\n", "\x0bx"])
        out.append((i, text, source))
    return out


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(rows, weights=(3, 1, 2), budget=1.5, cap=2.0):
    totals = {}
    for _, t, s in rows:
        totals[s] = totals.get(s, 0) + size(t)
    order = sorted((s for s in totals if s is not None), key=lambda s: s.encode()) + [None] * (None in totals)
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    fixed, left = {}, budget * sum(totals.values())
    while True:
        open_ = [s for s in order if s not in fixed]
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * totals[s] + 1e-9]
        if not over:
            return totals, fixed | share
        for s in over:
            fixed[s] = cap * totals[s]
            left -= fixed[s]


@pytest.mark.parametrize("bucket_rows", [7, 2000])
def test_targets_and_takes(spark, bucket_rows):
    data = rows()
    df = spark.createDataFrame([(*r, 1, 2) for r in data], SCHEMA + ", size int, target int")
    out = {r.id: r for r in mixing.mix(df, bucket_rows=bucket_rows).collect()}
    totals, want = brute_targets(data)
    assert len(out) == len(data)
    taken = {}
    for i, t, s in data:
        r = out[i]
        assert r.size == size(t) and r.source_size == totals[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 2 * r.size and (r.position is None) == (r.taken == 0)
        taken[s] = taken.get(s, 0) + r.taken
    for s, n in taken.items():
        assert n == int(want[s] + 1e-6)
    again = {r.id: r for r in mixing.mix(df.repartition(5, "text"), bucket_rows=bucket_rows).collect()}
    assert again == out


def test_positions_follow_the_schedule(spark):
    """At every time the words before it match the integral of the source's schedule."""
    data = [(i, "w w w", "ab"[i % 2]) for i in range(2000)]
    mixed = mixing.mix(spark.createDataFrame(data, SCHEMA)).collect()
    for source, rank in (("a", 0), ("b", 1)):
        knots = mixing.RAMPS[rank]
        mine = [r for r in mixed if "ab"[r.id % 2] == source]
        for t in (0.2, 0.5, 0.8):
            (t0, f0), (t1, f1) = knots
            area = f0 * t + (f1 - f0) / (t1 - t0) * t * t / 2
            first = min(1.0, area * mine[0].target / mine[0].source_size)
            seen = sum(r.position is not None and r.position < t for r in mine) / len(mine)
            assert seen == pytest.approx(first, abs=0.02)


def test_order_and_edges(spark):
    df = spark.createDataFrame(rows(60), SCHEMA)
    order = [r.position for r in mixing.training_order(mixing.mix(df)).collect()]
    known = [p for p in order if p is not None]
    assert known == sorted(known) and order[: len(known)] == known
    assert mixing.mix(df.limit(0)).collect() == []
    blank = spark.createDataFrame([(1, None, None), (2, "", None)], SCHEMA)
    assert {(r.size, r.target, r.taken) for r in mixing.mix(blank).collect()} == {(0, 0.0, 0)}
    repeated = df.union(df).filter(F.col("doc_id") < 9)
    assert mixing.mix(repeated).count() == 18


def test_every_pass_has_its_position(spark):
    """Sources taken more than once follow their schedule to the end, words of later passes included."""
    data = [(i, "w w w", "ab"[i % 2]) for i in range(2000)]
    rows_ = mixing.training_order(mixing.mix(spark.createDataFrame(data, SCHEMA))).collect()
    taken = {r.id: r.taken for r in rows_}
    assert sum(r.words for r in rows_) == sum(taken.values()) == 9000
    assert len(rows_) == 3000 and all((r.position is None) == (r.words == 0) for r in rows_)
    order = [r.position for r in rows_]
    assert order == sorted(order)
    for source, knots in (("a", mixing.RAMPS[0]), ("b", mixing.RAMPS[1])):
        mine = [r for r in rows_ if "ab"[r.id % 2] == source]
        (t0, f0), (t1, f1) = knots
        for t in (0.2, 0.5, 0.8, 0.95):
            area = f0 * t + (f1 - f0) / (t1 - t0) * t * t / 2
            assert sum(r.words for r in mine if r.position < t) / mine[0].target == pytest.approx(area, abs=0.01)
    assert {r["pass"] for r in rows_ if r.id % 2 == 0} == {0, 1}


def test_positions_are_the_exact_inverse(spark):
    """Each copy's position is where the schedule's integral, solved by bisection, equals the words before it."""
    data = rows(200)
    mixed = mixing.mix(spark.createDataFrame(data, SCHEMA)).collect()
    source_of = {i: s for i, _, s in data}
    order = sorted({s for s in source_of.values() if s is not None}, key=lambda s: s.encode()) + [None]

    def spent(knots, t):
        total = 0.0
        for (t0, f0), (t1, f1) in zip(knots, knots[1:]):
            if t > t0:
                x = min(t, t1) - t0
                total += f0 * x + (f1 - f0) / (t1 - t0) * x * x / 2
        return total

    for rank, source in enumerate(order):
        knots = mixing.RAMPS[rank % 3]
        copies = sorted((p["pass"], p["position"], p["words"], r.target) for r in mixed if source_of[r.id] == source for p in r.passes)
        before = 0
        for _, at, words, target in copies:
            low, high = 0.0, 1.0
            for _ in range(60):
                middle = (low + high) / 2
                low, high = (middle, high) if spent(knots, middle) < before / target else (low, middle)
            assert at == pytest.approx(low, abs=1e-9)
            before += words


def test_hot_ids_and_copies_keep_buckets_small(spark):
    """Neither a third of rows without id nor a third of equal rows meets in one bucket."""
    data = [(None, f"w {i}", "a") for i in range(300)] + [(7, "w w", "a")] * 300 + [(100 + i, "w", "b") for i in range(300)]
    df = spark.createDataFrame(data, SCHEMA)
    out = mixing.mix(df, bucket_rows=20).collect()
    assert len(out) == 900
    totals, want = brute_targets(data)
    for s, name in (("a", "a"), ("b", "b")):
        mine = [r for r in out if (r.id is None or r.id == 7) == (name == "a")]
        assert sum(r.taken for r in mine) == int(want[s] + 1e-6) and {r.source_size for r in mine} == {totals[s]}
        passes = sorted((p["pass"], p["position"]) for r in mine for p in r.passes)
        assert [p for _, p in passes] == sorted(p for _, p in passes)
