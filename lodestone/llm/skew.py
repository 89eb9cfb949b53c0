"""Scatters and row places that no single key can load onto one task; joins and prefix sums come from the core."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.skew import FEW, counted_join, prefix_sums, salted_join
from lodestone.session import materialize

__all__ = ["FEW", "FILE", "ROW", "counted_join", "is_scan", "placed", "prefix_sums", "salted_join", "spread"]
FILE, ROW = "__file", "__row"


def spread(table: DataFrame, h: str, place: Column, limit: int, few: int = FEW) -> DataFrame:
    """``table`` with hashes in ``h`` that more than ``limit`` rows share replaced by each row's ``place``."""
    hot = table.groupBy(h).agg(F.count("*").alias("__rows")).filter(F.col("__rows") > limit).select(h, F.lit(True).alias("__hot"))
    marked = counted_join(table.withColumn("__place", place), hot, [h], F.col("__place"), "left", few)
    return marked.withColumn(h, F.when(F.col("__hot"), F.col("__place")).otherwise(F.col(h))).drop("__hot", "__place")


def is_scan(df: DataFrame) -> bool:
    """Whether rows still know their place in the files that they come from."""
    return "_metadata#" in df._jdf.queryExecution().analyzed().metadataOutput().mkString(",")


def placed(df: DataFrame, label: str) -> DataFrame:
    """``df`` with the file and row number of each row, which are one row's alone; other than a scan is written first."""
    scan = df if is_scan(df) else materialize(df, label)
    return scan.withColumns({FILE: F.col("_metadata.file_name"), ROW: F.col("_metadata.row_index")})
