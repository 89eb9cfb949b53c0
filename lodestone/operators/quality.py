"""Graph-quality statistics of a knowledge base."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.graph import connected_components
from lodestone.session import materialize


def ratio(part: Column, whole: Column, places: int = 4) -> Column:
    """Rounded quotient, null for an empty whole."""
    return F.round(part / F.nullif(whole.cast("double"), F.lit(0.0)), places)


def degrees(edges: DataFrame) -> DataFrame:
    """``(node, degree)``; a self-loop counts twice."""
    return edges.select(F.explode(F.array("source", "target")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))


def singleton_edges(edges: DataFrame) -> DataFrame:
    """Edges both of whose ends have degree 1."""
    # Written first, so that a short list is broadcast instead of shuffling all edges to it.
    alone = materialize(degrees(edges).filter("degree = 1").select("node"), "degree-one")
    return edges.join(alone.withColumnRenamed("node", "source"), "source", "left_semi").join(alone.withColumnRenamed("node", "target"), "target", "left_semi")


def largest_component(edges: DataFrame) -> DataFrame:
    """One row with the node count of the largest component."""
    nodes = edges.select(F.explode(F.array("source", "target")).alias("node")).distinct()
    labels = connected_components(edges.select(F.col("source").alias("a"), F.col("target").alias("b")))
    rooted = nodes.join(labels, "node", "left").select(F.coalesce("root", "node").alias("root"))
    return rooted.groupBy("root").agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0)).alias("largest"))


def reused_entities(entity_documents: DataFrame) -> DataFrame:
    """One row with the number of entities seen in at least two documents."""
    seen = entity_documents.groupBy("entity_id").agg(F.countDistinct("document_id").alias("n"))
    return seen.agg(F.count_if(F.col("n") >= 2).alias("reused"))


def graph_quality(edges: DataFrame, entity_documents: DataFrame, totals: DataFrame) -> DataFrame:
    """All ratios in one row; ``totals`` has ``mentions``, ``entities`` and ``evidence``."""
    shape = edges.agg(F.count("*").alias("n_edges"), F.count_if(F.lower("relation") == "other").alias("n_other"))
    row = totals.crossJoin(shape).crossJoin(singleton_edges(edges).agg(F.count("*").alias("n_single"))).crossJoin(largest_component(edges)).crossJoin(reused_entities(entity_documents))
    c = F.col
    return row.select(
        ratio(c("n_single"), c("n_edges")).alias("singleton_ratio"),
        ratio(c("largest"), c("entities")).alias("largest_component_ratio"),
        ratio(c("mentions"), c("entities")).alias("compression"),
        ratio(c("reused"), c("entities")).alias("reuse_ratio"),
        ratio(c("n_other"), c("n_edges")).alias("other_ratio"),
        ratio(F.greatest(c("evidence") - c("n_edges"), F.lit(0)), c("evidence")).alias("duplicate_ratio"),
    )
