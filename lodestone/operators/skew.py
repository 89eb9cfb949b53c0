"""Joins, row numbers and prefix sums that no single key, and no global order, can load onto one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.session import materialize

_SALT, _PART = "__salt", "__part"
#: Rows of a side that may be broadcast after they were counted.
FEW = 10_000


def salted_join(wide: DataFrame, thin: DataFrame, keys: list[str], salt: Column, how: str = "inner", salts: int = 16, hint: str | None = None) -> DataFrame:
    """``wide`` joined to ``thin`` on ``keys``, where ``thin`` has at most a few rows per key.

    Rows of ``wide`` that share a key are dealt over ``salts`` tasks by the integer column ``salt``; every
    row of ``thin`` is repeated once per salt, so the cost is ``salts`` times the smaller side.  Whether the
    repeated side is broadcast is left to Spark's size check.
    """
    dealt = wide.withColumn(_SALT, F.pmod(salt, F.lit(salts)).cast("int"))
    repeated = thin.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(repeated.hint(hint) if hint else repeated, [*keys, _SALT], how).drop(_SALT)


def counted_join(wide: DataFrame, thin: DataFrame, keys: list[str], salt: Column, how: str = "inner", few: int = FEW) -> DataFrame:
    """As :func:`salted_join`, but a ``thin`` table of at most ``few`` rows, counted first, is broadcast."""
    if thin.count() <= few:
        return wide.join(F.broadcast(thin), keys, how)
    return salted_join(wide, thin, keys, salt, how)


def prefix_sums(rows: DataFrame, keys: list[str], order: str, value: str, out: str, block: int = 1000) -> DataFrame:
    """``(keys, order, out)``: the sum of ``value`` over the smaller ``order`` numbers of the same keys.

    Sums run inside blocks of ``block`` order numbers and then over the blocks, so one task sees the blocks
    of a key, not its rows.
    """
    parted = rows.select(*keys, order, value, F.floor(F.col(order) / block).cast("long").alias("__block"))
    inside = Window.partitionBy(*keys, "__block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = parted.groupBy(*keys, "__block").agg(F.sum(value).alias("__sum")).withColumn("__start", F.coalesce(F.sum("__sum").over(before), F.lit(0))).drop("__sum")
    placed = parted.withColumn("__inner", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(blocks, [*keys, "__block"])
    return placed.select(*keys, order, (F.col("__start") + F.col("__inner")).alias(out))


def running_counts(df: DataFrame, order: list[str], **tests: Column) -> DataFrame:
    """``df`` with, per name in ``tests``, how many rows up to and including this one pass it, in the order of ``order``.

    Rows are dealt by ranges of the order and written once; counts run inside a range, and the ranges'
    totals are added up over one short row each.
    """
    flags = df.withColumns({f"__is_{n}": F.coalesce(t, F.lit(False)).cast("long") for n, t in tests.items()})
    ranged = materialize(flags.repartitionByRange(*order).withColumn(_PART, F.spark_partition_id()), "ranged")
    inside = Window.partitionBy(_PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(_PART).agg(*[F.sum(f"__is_{n}").alias(f"__sum_{n}") for n in tests])
    starts = totals.select(_PART, *[F.coalesce(F.sum(f"__sum_{n}").over(before), F.lit(0)).alias(f"__start_{n}") for n in tests])
    counted = ranged.withColumns({f"__in_{n}": F.sum(f"__is_{n}").over(inside) for n in tests}).join(starts, _PART)
    return counted.select(*df.columns, *[(F.col(f"__start_{n}") + F.col(f"__in_{n}")).alias(n) for n in tests])
