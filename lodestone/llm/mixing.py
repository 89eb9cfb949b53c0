"""Mixing sources to target weights along a time-varying curriculum, in DataFrame operations only.

Each source has a weight schedule over training time 0..1, piecewise linear.  Its integral is the
source's share of the word budget; a target above ``max_repeats`` times the source's size is cut there
and the excess is shared by weight among the others (water filling, solved over the sources' totals).
A document starts at the cumulative word offset that a seeded hash order gives it inside its source,
and again one source size later in every further pass over the source; inverting the cumulative demand
at each of these offsets yields the training positions of its copies.

Prefix sums run in levels, so no source is ever ordered in one task: a source is dealt into hash
buckets of about ``bucket_rows`` rows, as many as its own rows need, buckets are summed in blocks, and
rows are ordered within their bucket.  Rows are dealt by id and text; large groups of equal ones by their
place in the table, so no group of copies fills a bucket.  The targets of all sources are solved in one
task, which holds a short row per source.

A null source is a source of its own and sorts last.  A null text has size 0 and takes nothing; very
long texts are counted whole.  A source without words has target 0.  Rows that repeat an id, or repeat
as a whole, are separate rows of the mix; of equal rows at the end of a source's target any may be the
one that is cut.  An empty table gives no row.  Other columns are returned only if they are named in
``keys``, which must not be names of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.skew import counted_join, prefix_sums, spread
from lodestone.llm.words import word_count
from lodestone.session import materialize

WEIGHTS = (3.0, 1.0, 2.0)
#: Knots (time, factor) of the schedules that sources follow in turn; each integrates to 1.
RAMPS = (((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (0.5, 1.0), (1.0, 1.0)))


def segments(weight: float, knots) -> list[tuple[float, float, float, float]]:
    """``(start, weight there, slope, integral so far)`` of each linear piece of a schedule."""
    out, total = [], 0.0
    for (t0, f0), (t1, f1) in zip(knots, knots[1:]):
        out.append((t0, weight * f0, weight * (f1 - f0) / (t1 - t0), total))
        total += weight * (f0 + f1) / 2 * (t1 - t0)
    return out


def integral(weight: float, knots) -> float:
    return sum(weight * (f0 + f1) / 2 * (t1 - t0) for (t0, f0), (t1, f1) in zip(knots, knots[1:]))


def _turn(rank: Column, made: list[Column]) -> Column:
    """The entry of ``made`` whose turn it is at this 0-based rank."""
    return F.get(F.array(*made), F.pmod(rank, F.lit(len(made))).cast("int"))


def targets(totals: DataFrame, budget: float, max_repeats: float, weights, ramps) -> DataFrame:
    """Adds weight, schedule and water-filled target to ``(source, source_key, source_size)``."""
    plan = [(weights[i % len(weights)], ramps[i % len(ramps)]) for i in range(len(weights) * len(ramps))]
    ranked = totals.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("weight", _turn(F.col("rank"), [F.lit(float(integral(w, k))) for w, k in plan]))
    pieces = [
        F.array(*[F.struct(F.lit(t).alias("t"), F.lit(w).alias("w"), F.lit(s).alias("slope"), F.lit(c).alias("done")) for t, w, s, c in segments(w0, k)])
        for w0, k in plan
    ]
    ranked = ranked.withColumn("pieces", _turn(F.col("rank"), pieces)).withColumn("cap", F.col("source_size") * F.lit(float(max_repeats)))
    ordered = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.lit(float(budget)) * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    filled = ranked.withColumn("level", level).withColumn("level", F.max("level").over(whole))
    return filled.withColumn("target", F.least("cap", F.col("level") * F.col("weight"))).select("source_key", "source_size", "source_rows", "target", "weight", "pieces")


def invert(share: Column, weight: Column, pieces: Column) -> Column:
    """Training time at which a schedule has spent ``share`` (0..1) of its integral."""
    spent = share * weight
    piece = F.element_at(F.filter(pieces, lambda p: p.done <= spent), -1)
    rest = spent - piece.done
    root = F.sqrt(F.greatest(piece.w * piece.w + 2 * piece.slope * rest, F.lit(0.0)))
    return F.least(F.lit(1.0), piece.t + F.when(rest <= 0, F.lit(0.0)).otherwise(2 * rest / (piece.w + root)))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    ramps=RAMPS,
    budget: float = 1.5,
    max_repeats: float = 2.0,
    seed: int = 2024,
    bucket_rows: int = 200,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """``id, size, source_size, target, taken, copies, position, passes`` per row, plus the columns ``keys``.

    ``copies`` is ``taken`` in whole documents, rounded half up.  ``passes`` holds ``(pass, words,
    position)`` of every pass that takes words of the document; the words add up to ``taken``.
    ``position`` is the training time of the first copy, null where nothing is taken.
    """
    thin = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("-")).alias("source_key"),
        word_count(F.col(text_col)).alias("size"),
        F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed)).alias("h"),
        *[F.col(k).alias(f"key_{k}") for k in keys],
    )
    thin = materialize(thin, "mix-thin")
    totals = thin.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    goals = materialize(targets(totals, budget, max_repeats, weights, ramps), "mix-goals")
    # A part's number and a row's place in it stay the same in a rerun; the rest of the file's name does not.
    place = F.xxhash64(F.substring_index("_metadata.file_name", "-", 2), "_metadata.row_index", F.lit(seed))
    thin = counted_join(spread(thin, "h", place, bucket_rows), goals, ["source_key"], F.col("h"))
    thin = thin.withColumn("bucket", F.pmod(F.shiftright("h", 20), F.ceil(F.col("source_rows") / bucket_rows)))
    dealt = materialize(thin.groupBy("source_key", "bucket").agg(F.sum("size").alias("bucket_size")), "mix-buckets")
    placed = prefix_sums(dealt, ["source_key"], "bucket", "bucket_size", "offset")
    inside = Window.partitionBy("source_key", "bucket").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("offset") + F.col("inner")
    passes = -(-int(max_repeats * 1000) // 1000)
    goal = F.floor("target")
    each = [F.greatest(F.lit(0), F.least(F.col("size"), goal - F.lit(e) * F.col("source_size") - start)) for e in range(passes)]
    taken = each[0]
    for x in each[1:]:
        taken = taken + x
    out = thin.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(placed, ["source_key", "bucket"])
    out = out.withColumn("taken", taken.cast("long"))
    at = lambda e: invert((start + F.lit(e) * F.col("source_size")) / F.col("target"), F.col("weight"), F.col("pieces"))
    dealt_out = F.array(*[F.struct(F.lit(e).alias("pass"), x.cast("long").alias("words"), F.when(x > 0, at(e)).alias("position")) for e, x in enumerate(each)])
    out = out.withColumn("passes", F.filter(dealt_out, lambda p: p["words"] > 0))
    copies = F.when(F.col("taken") > 0, F.floor(F.col("taken") / F.col("size") + F.lit(0.5))).otherwise(F.lit(0)).cast("int")
    return out.select("id", "size", "source_size", "target", "taken", copies.alias("copies"), F.get("passes", F.lit(0))["position"].alias("position"), "passes", *[F.col(f"key_{k}").alias(k) for k in keys])


def range_sorted(mixed: DataFrame) -> DataFrame:
    """One row per document, range-sorted by the training position of its first copy; rows that are not taken come last."""
    return mixed.orderBy(F.col("position").asc_nulls_last(), "id")


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per pass of a document, range-sorted by the training position of that pass.

    ``pass`` and ``words`` say which pass it is and what it takes; rows that are not taken come last,
    with pass null.
    """
    each = mixed.withColumn("x", F.explode_outer("passes")).drop("passes", "position")
    each = each.withColumns({"pass": F.col("x.pass"), "words": F.coalesce("x.words", F.lit(0).cast("long")), "position": F.col("x.position")}).drop("x")
    return each.orderBy(F.col("position").asc_nulls_last(), "id", "pass")
