"""Two-pass external shuffle into shards of equal row counts, in DataFrame operations only.

Pass 1 scatters whole records over memory-sized buckets by a seeded hash.  Pass 2 puts each bucket into
a fixed order, shuffles it with Fisher-Yates and writes it; buckets lie end to end, so a row's place
there is its global position.  Shards are consecutive runs of positions whose lengths differ by at most
one, and a slot is the place inside the shard.  The result is what the written shards hold.

The bucket count follows the rows and bytes, so a bucket fits in memory at every size.  A record is
scattered by its id, size and text; groups of equal records with more than an eighth of a bucket's rows
are scattered by their place in the input files instead, so no group of copies fills a bucket.  Buckets
and their order do not depend on how Spark deals the input, so a rerun and a recomputed task give the
same shards (equal records of a large group may change places).

Null texts have no bytes; null ids are records like any other; rows that repeat an id, or repeat as a
whole, are separate records.  Ties of the hash are broken by the whole record.  Very long texts are
written whole; a record above the bucket size fills a bucket.  An empty table gives no shard.  All input
columns are kept, whatever their names; only ``shard`` and ``slot`` give way to the result's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.skew import FEW, FILE, ROW, placed, prefix_sums, salted_join
from lodestone.session import materialize, scratch_path

LAW = "rows"
#: Bytes that a record takes besides its text.
OVERHEAD = 8
_H, _ROW, _HOT, _BUCKET, _HELD, _OFFSET, _AT = (f"__shard_{x}" for x in ("h", "row", "hot", "bucket", "held", "offset", "at"))


def body_of(text_col: str) -> Column:
    return F.coalesce(F.col(text_col), F.lit("")).cast("binary")


def size_of(text_col: str) -> Column:
    return (F.octet_length(body_of(text_col)) + OVERHEAD).cast("long")


def shuffled_positions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, bucket_rows: int = 50_000, bucket_bytes: int = 1 << 24, most_tasks: int = 20_000, few: int = FEW) -> tuple[DataFrame, int]:
    """All columns of ``docs`` with the record's global position in ``__shard_at``, and the row count.

    One task works through its buckets in order, so more than ``most_tasks`` buckets need no more tasks.
    """
    names = docs.columns
    source = placed(docs, "shard-records").withColumn(_ROW, F.xxhash64(F.substring_index(FILE, "-", 2), ROW, F.lit(seed))).drop(FILE, ROW)
    hashed = source.withColumn(_H, F.xxhash64(F.lit(seed), F.col(id_col), size_of(text_col), F.crc32(body_of(text_col))))
    groups = materialize(hashed.select(_H, size_of(text_col).alias("size")).groupBy(_H).agg(F.count("*").alias("n"), F.sum("size").alias("b")), "shard-groups")
    facts = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
    buckets = max(1, -(-facts.n // bucket_rows), -(-facts.b // bucket_bytes))
    by = lambda c: F.pmod(F.col(c), F.lit(buckets)).alias(_BUCKET)
    large = groups.filter(F.col("n") > max(1, facts.n // buckets // 8))
    hot = large.select(_H, F.lit(True).alias(_HOT))
    n_hot = hot.count()
    if n_hot:
        marked = hashed.join(F.broadcast(hot), _H, "left") if n_hot <= few else salted_join(hashed, hot, [_H], F.col(_ROW), "left")
        marked = marked.withColumn(_BUCKET, F.when(F.col(_HOT), by(_ROW)).otherwise(by(_H))).drop(_HOT)
        spread = marked.select(_H, _BUCKET).join(F.broadcast(hot) if n_hot <= few else hot, _H, "left_semi").groupBy(_BUCKET).agg(F.count("*").alias("n"))
        counts = groups.join(hot, _H, "left_anti").select(by(_H), "n").unionByName(spread)
    else:
        marked = hashed.withColumn(_BUCKET, by(_H))
        counts = groups.select(by(_H), "n")
    record = F.struct(F.col(_H), F.struct(*[F.col(f"`{c}`") for c in names]).alias("r"))
    compare = (lambda a, b: F.when(a[_H] < b[_H], -1).when(a[_H] > b[_H], 1).otherwise(0)) if "map<" in docs.schema.simpleString() or "variant" in docs.schema.simpleString() else None
    filled = marked.repartition(min(buckets, most_tasks), _BUCKET).groupBy(_BUCKET).agg(F.array_sort(F.collect_list(record), compare).alias(_HELD))
    turned = filled.sortWithinPartitions(_BUCKET).select(_BUCKET, F.shuffle(_HELD, seed).alias(_HELD))
    begins = prefix_sums(counts.groupBy(_BUCKET).agg(F.sum("n").alias("n")), [], _BUCKET, "n", _OFFSET)
    laid = turned.join(begins, _BUCKET).select(_OFFSET, F.posexplode(_HELD).alias(_AT, _ROW))
    return laid.select(f"{_ROW}.r.*", (F.col(_OFFSET) + F.col(_AT)).alias(_AT)), facts.n


def write_shards(docs: DataFrame, path: str | None = None, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, **buckets) -> DataFrame:
    """Writes whole records in shuffled order below ``path/shard=N`` and returns them as a table, with ``shard`` and ``slot``.

    Records of a bucket are shuffled in memory and written by one task, which opens only the shards that
    its run of positions touches; inside a file rows keep their slots.
    """
    path = path or scratch_path(docs.sparkSession, "shards")
    kept = docs.drop("shard", "slot")
    laid, rows = shuffled_positions(kept, id_col, text_col, seed, **buckets)
    # Shard s begins at position ceil(s * rows / shards).
    laid = laid.withColumn("shard", F.expr(f"{_AT} * {shards} div {max(rows, 1)}").cast("int"))
    laid = laid.withColumn("slot", F.col(_AT) - F.expr(f"(shard * {rows}L + {shards - 1}) div {shards}")).drop(_AT)
    laid.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(laid.schema).parquet(path).select(*laid.columns)


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, path: str | None = None, **buckets) -> DataFrame:
    """``id, size, text_crc32, law, shard, slot, grown_shard`` of every record, read back from its shard."""
    whole = write_shards(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), path, shards, "id", "text", seed, **buckets)
    return whole.select(
        "id", size_of("text").alias("size"), F.crc32(body_of("text")).alias("text_crc32"), F.lit(LAW).alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
