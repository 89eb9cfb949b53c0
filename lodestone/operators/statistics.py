"""The knowledge statistics document: totals, groups, ratios, as one JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.quality import graph_quality, ratio
from lodestone.session import materialize

#: Total name, table it counts, and what of the table: rows, distinct values of a column, or rows that pass.
TOTALS: list[tuple[str, str, str, Column | str | None]] = [
    ("documents", "documents", "rows", None),
    ("document_revisions", "document_revisions", "rows", None),
    ("processing_jobs", "processing_jobs", "rows", None),
    ("extraction_runs", "extraction_runs", "rows", None),
    ("extracted_documents", "extraction_runs", "distinct", "document_id"),
    ("entity_mentions", "entity_mentions", "rows", None),
    ("unique_mention_texts", "entity_mentions", "distinct", "lower(mention_text)"),
    ("raw_assertions", "raw_assertions", "rows", None),
    ("evidence_validated", "raw_assertions", "passing", "evidence_validated"),
    ("assertion_documents", "raw_assertions", "distinct", "document_id"),
    ("entities", "entities", "rows", None),
    ("assertions", "assertions", "rows", None),
    ("relation_types", "relation_types", "rows", None),
    ("resolved_mentions", "entity_resolutions", "rows", None),
    ("evidence_links", "assertion_evidence", "rows", None),
    ("invalid_records", "invalid_records", "rows", None),
]


def totals(tables: dict[str, DataFrame]) -> DataFrame:
    """One row with the sixteen totals; a table that is not given counts as empty.  Each table is read once."""
    row = None
    for name in dict.fromkeys(t for _, t, _, _ in TOTALS):
        wanted = [(out, how, what) for out, t, how, what in TOTALS if t == name]
        if name in tables:
            made = {"rows": lambda what: F.count("*"), "distinct": lambda what: F.countDistinct(F.expr(what)), "passing": lambda what: F.count_if(F.expr(what))}
            part = tables[name].agg(*[made[how](what).alias(out) for out, how, what in wanted])
        else:
            part = next(iter(tables.values())).sparkSession.range(1).select(*[F.lit(0).cast("long").alias(out) for out, _, _ in wanted])
        row = part if row is None else row.crossJoin(part)
    return row


def group_counts(table: DataFrame | None, column: str, spark) -> DataFrame:
    """One row with ``counts``: the number of rows of each value, as a map in the order of the values."""
    if table is None:
        return spark.range(1).select(F.create_map().cast("map<string,bigint>").alias("counts"))
    counted = table.groupBy(F.col(column).cast("string").alias("k")).agg(F.count("*").alias("n")).filter("k is not null")
    return counted.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias("counts"))


def job_details(jobs: DataFrame | None, spark) -> DataFrame:
    """One row with ``by_status`` and ``details``; stages, versions and statuses are few by their nature."""
    if jobs is None:
        return spark.range(1).select(F.create_map().cast("map<string,bigint>").alias("by_status"), F.array().cast("array<struct<stage:string,stage_version:string,status:string,count:bigint>>").alias("details"))
    each = jobs.groupBy("stage", "stage_version", "status").agg(F.count("*").alias("count"))
    details = each.agg(F.array_sort(F.collect_list(F.struct("stage", "stage_version", "status", "count"))).alias("details"))
    by_status = group_counts(jobs, "status", spark).withColumnRenamed("counts", "by_status")
    return by_status.crossJoin(details)


def knowledge_statistics(tables: dict[str, DataFrame]) -> DataFrame:
    """One row with the nested statistics ``documents, processing_jobs, bronze_knowledge, canonical_knowledge, quality, graph_quality``.

    ``tables`` are named as in ``TOTALS``.  Graph ratios need ``assertions`` with ``source``, ``target`` and
    ``relation``, and ``entity_documents``; without them they are null.
    """
    spark = next(iter(tables.values())).sparkSession
    if "assertions" in tables and "entity_documents" in tables:
        # Counted and searched several times, but made once, with the columns that count.
        tables = tables | {"assertions": materialize(tables["assertions"].select("source", "target", "relation"), "assertions")}
    given = tables.get
    row = totals(tables)
    named = lambda df, a, b: df.withColumnRenamed(a, b)
    row = row.crossJoin(named(group_counts(given("documents"), "source_type", spark), "counts", "source_types"))
    row = row.crossJoin(job_details(given("processing_jobs"), spark))
    row = row.crossJoin(named(group_counts(given("extraction_runs"), "pass_name", spark), "counts", "passes"))
    row = row.crossJoin(named(group_counts(given("entity_mentions"), "entity_type", spark), "counts", "entity_types"))
    ratios = ("singleton_ratio", "largest_component_ratio", "compression", "reuse_ratio", "other_ratio", "duplicate_ratio")
    if "assertions" in tables and "entity_documents" in tables:
        counted = row.select(F.col("resolved_mentions").alias("mentions"), "entities", F.col("evidence_links").alias("evidence"))
        row = row.crossJoin(graph_quality(tables["assertions"], tables["entity_documents"], counted).select(F.struct(*ratios).alias("graph_quality")))
    else:
        row = row.withColumn("graph_quality", F.struct(*[F.lit(None).cast("double").alias(r) for r in ratios]))
    c = F.col
    return row.select(
        F.struct(c("documents").alias("total"), c("document_revisions").alias("revisions"), c("source_types").alias("by_source_type")).alias("documents"),
        F.struct(c("processing_jobs").alias("total"), "by_status", "details").alias("processing_jobs"),
        F.struct(
            "extraction_runs", c("extracted_documents").alias("documents_with_completed_extraction"), c("passes").alias("extraction_runs_by_pass"), "entity_mentions", "unique_mention_texts",
            c("entity_types").alias("entity_mentions_by_type"), "raw_assertions", c("assertion_documents").alias("documents_with_assertions"), "evidence_validated", (c("raw_assertions") - c("evidence_validated")).alias("evidence_not_validated"),
        ).alias("bronze_knowledge"),
        F.struct("entities", "assertions", "relation_types", "resolved_mentions", "evidence_links").alias("canonical_knowledge"),
        F.struct("invalid_records", ratio(c("evidence_validated"), c("raw_assertions")).alias("evidence_validation_rate")).alias("quality"),
        "graph_quality",
    )


def as_json(statistics: DataFrame) -> str:
    """The document as JSON text, nulls included."""
    return statistics.select(F.to_json(F.struct(*statistics.columns), {"ignoreNullFields": "false"}).alias("j")).first().j
