import random
import zlib
from types import SimpleNamespace

from lodestone.llm import sharding

SCHEMA = "doc_id long, text string, slot string"


def frame(spark, n=500):
    rng = random.Random(3)
    return spark.createDataFrame([(i, rng.choice([None, "", "copy", "ünï" * rng.randint(1, 9)]), "x") for i in range(n)], SCHEMA)


def check(out, docs, shards):
    want = sorted(((d.doc_id, len((d.text or "").encode()) + 8, zlib.crc32((d.text or "").encode())) for d in docs), key=str)
    assert sorted(((r.id, r.size, r.text_crc32) for r in out), key=str) == want
    slots = {s: sorted(r.slot for r in out if r.shard == s) for s in range(shards)}
    assert all(v == list(range(len(v))) for v in slots.values())
    sizes = [len(v) for v in slots.values()]
    assert sum(sizes) == len(out) and max(sizes) - min(sizes) <= 1
    assert {(r.law, r.grown_shard) for r in out} <= {("rows", None)}


def test_law_of_rows(spark):
    df = frame(spark)
    docs = df.collect()
    for rows in (40, 50_000):
        out = sharding.shard(df, bucket_rows=rows).collect()
        check(out, docs, 24)
        again = sharding.shard(df.repartition(7), bucket_rows=rows).collect()
        assert sorted(out) == sorted(again)


def test_order_is_shuffled(spark):
    out = sorted(sharding.shard(frame(spark, 2000), shards=1).collect(), key=lambda r: r.slot)
    ids = [r.id for r in out]
    rising = sum(a < b for a, b in zip(ids, ids[1:])) / (len(ids) - 1)
    assert 0.45 < rising < 0.55
    assert sum(abs(i - r.slot) for i, r in zip(ids, out)) / len(ids) > 400
    other = sorted(sharding.shard(frame(spark, 2000), shards=1, seed=8).collect(), key=lambda r: r.slot)
    assert [r.id for r in other] != ids


def test_edges(spark):
    df = frame(spark, 10)
    check(sharding.shard(df).collect(), df.collect(), 24)
    assert sharding.shard(df.limit(0)).collect() == []
    twice = df.union(df)
    check(sharding.shard(twice, shards=3).collect(), twice.collect(), 3)
    no_id = spark.createDataFrame([(None, "a", "x"), (None, "b", "x")], SCHEMA)
    assert sharding.shard(no_id, shards=2).count() == 2


def test_written_shards_hold_whole_records(spark, tmp_path):
    df = frame(spark, 200)
    back = sharding.write_shards(df, str(tmp_path / "out"), shards=5, bucket_rows=30).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=str) == sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    for s in range(5):
        assert sorted(r.slot for r in back if r.shard == s) == list(range(40))


def test_one_hot_record_is_spread_over_the_buckets(spark):
    """A third of all rows are one record, a third have no id: no bucket grows beyond its share."""
    rows = [(7, "copy", "x")] * 400 + [(None, f"text {i % 300}", "x") for i in range(400)] + [(1000 + i, f"own {i}", "x") for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    out = sharding.shard(df, shards=6, bucket_rows=60).collect()
    assert sum(r.id == 7 for r in out) == 400 and len(out) == 1200
    check(out, [SimpleNamespace(doc_id=i, text=t) for i, t, _ in rows], 6)
    held = [r for r in out if r.id == 7]
    assert max(sum(r.shard == s for r in held) for s in range(6)) < 130  # 67 each, if spread evenly
    placed, _ = sharding.shuffled_positions(df, bucket_rows=60)
    plan = placed._jdf.queryExecution().toString()
    assert "__shard_hot" in plan
    assert sorted((r.id for r in sharding.shard(df, shards=6, bucket_rows=60, few=0).collect() if r.id), key=str) == sorted((r[0] for r in rows if r[0]), key=str)


def test_scatter_and_shuffle_by_hand(spark, tmp_path):
    """Buckets are the seeded hash of a record; each is a permutation of its records and they lie end to end."""
    df = frame(spark, 300)
    placed, n = sharding.shuffled_positions(df, bucket_rows=50)
    at = {r.doc_id: r["__shard_at"] for r in placed.collect()}
    assert n == 300 and sorted(at.values()) == list(range(300))
    hashed = df.selectExpr("doc_id", "xxhash64(7, doc_id, cast(octet_length(coalesce(text, '')) + 8 as bigint), crc32(cast(coalesce(text, '') as binary))) as h").collect()
    buckets = {}
    for r in hashed:
        buckets.setdefault(r.h % 6, []).append((r.h, r.doc_id))
    begin = 0
    for b in sorted(buckets):
        held = [i for _, i in sorted(buckets[b])]
        got = sorted(held, key=at.get)
        assert sorted(at[i] for i in held) == list(range(begin, begin + len(held)))
        assert got != held
        begin += len(held)


def test_all_input_columns_are_written(spark, tmp_path):
    names = ["h", "id", "position", "rows", "bucket", "size", "offset", "held"]
    df = frame(spark, 60).selectExpr("doc_id", "text", *[f"'{c}' as {c}" for c in names], "map('a', 1) as tags", "'mine' as shard", "'mine' as slot")
    out = sharding.write_shards(df, str(tmp_path / "out"), shards=3, bucket_rows=20)
    assert out.columns == ["doc_id", "text", *names, "tags", "shard", "slot"]
    rows = out.collect()
    assert len(rows) == 60 and all(r[c] == c for r in rows for c in names) and {r.shard for r in rows} == {0, 1, 2}
    assert sorted((r.doc_id, r.text) for r in rows if r.text) == sorted((r.doc_id, r.text) for r in df.collect() if r.text)


def test_a_table_of_files_is_not_copied_first(spark, tmp_path):
    frame(spark, 100).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    placed, _ = sharding.shuffled_positions(df, bucket_rows=30)
    assert "shard-records" not in placed._jdf.queryExecution().toString()
    check(sharding.shard(df, shards=4, bucket_rows=30).collect(), df.collect(), 4)
