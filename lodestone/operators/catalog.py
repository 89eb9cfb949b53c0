"""Literature catalog: selection gates, capped selection, sticky upserts and text batching."""

from __future__ import annotations

from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.text import compatible, filter_text
from lodestone.operators.skew import running_counts
from lodestone.session import materialize

# Fields of study that pass the default gate.
DEFAULT_FIELDS = (13, 24, 27, 28, 30, 36)


def matched_keywords(text: Column, keywords: list[str]) -> Column:
    """The keywords, as given, that are substrings of the folded text; keywords are folded here, once."""
    wanted = [F.when(F.contains(text, F.lit(compatible(k))), F.lit(k)) for k in keywords if k.strip()]
    return F.filter(F.array(*wanted), lambda k: k.isNotNull()) if wanted else F.array().cast("array<string>")


def field_gate(fields: Column, allowed: tuple[int, ...] | None = DEFAULT_FIELDS) -> Column:
    if allowed is None:
        return F.lit(True)
    return F.coalesce(F.arrays_overlap(fields, F.array(*map(F.lit, allowed))), F.lit(False))


def work_gate(title: Column, abstract: Column, fields: Column | None = None, *, allowed_fields=None, any_of: list[str] = (), all_of: list[str] = (), exclude: list[str] = (), sources: Column | None = None, source_contains: str | list[str] | None = None, require_abstract: bool = False, has_fulltext: Column | None = None) -> tuple[Column, Column]:
    """``(passes, matched keywords)`` of the conjunctive gate; cheap predicates come first."""
    text = filter_text(F.concat_ws("\n", F.coalesce(title, F.lit("")), F.coalesce(abstract, F.lit(""))))
    ok = field_gate(fields, allowed_fields) if fields is not None else F.lit(True)
    hit_any, hit_all = matched_keywords(text, list(any_of)), matched_keywords(text, list(all_of))
    if any(k.strip() for k in any_of):
        ok = ok & (F.size(hit_any) > 0)
    n_all = len([k for k in all_of if k.strip()])
    if n_all:
        ok = ok & (F.size(hit_all) == n_all)
    for word in exclude:
        if word.strip():
            ok = ok & ~F.contains(text, F.lit(compatible(word)))
    selectors = [source_contains] if isinstance(source_contains, str) else list(source_contains or ())
    if selectors:
        listed = filter_text(F.to_json(sources))  # names of members count as well
        ok = ok & F.coalesce(reduce(or_, [F.contains(listed, F.lit(compatible(x))) for x in selectors]), F.lit(False))
    if require_abstract:
        ok = ok & (F.length(F.trim(F.coalesce(abstract, F.lit("")))) > 0)
    if has_fulltext is not None:
        ok = ok & has_fulltext
    return ok, F.array_distinct(F.concat(hit_any, hit_all))


def require_filter(has_keywords: bool, has_source: bool, has_ids: bool, select_all: bool) -> None:
    """A scan of everything must be asked for."""
    if not (has_keywords or has_source or has_ids or select_all):
        raise ValueError("give a filter, ids, or ask for all works")


def capped_selection(works: DataFrame, passes: Column, order: list[str], explicit: Column, max_candidates: int | None, max_selected: int | None) -> DataFrame:
    """Adds ``method`` and ``selected``: explicit rows bypass the gate, caps follow scan order.

    Only candidates and explicit rows are returned; candidates over ``max_selected`` stay unselected.  Rows
    are counted over ranges of the order, in no single task.
    """
    kept = works.withColumn("__explicit", F.coalesce(explicit, F.lit(False))).withColumn("__candidate", F.coalesce(passes, F.lit(False)) & ~F.col("__explicit")).filter("__explicit or __candidate")
    counted = running_counts(kept, order, __nth=F.col("__candidate"))
    allowed = F.col("__explicit") | F.lit(max_candidates is None) | (F.col("__nth") <= (max_candidates or 0))
    counted = running_counts(counted.withColumn("__allowed", allowed), order, __at=F.col("__allowed")).filter("__allowed")
    chosen = F.col("__explicit") | F.lit(max_selected is None) | (F.col("__at") <= (max_selected or 0))
    return counted.withColumn("method", F.when(F.col("__explicit"), "manual").otherwise("filter")).withColumn("selected", chosen).drop("__explicit", "__candidate", "__nth", "__allowed", "__at")


def require_found(wanted: DataFrame, works: DataFrame) -> None:
    """Explicit ids that no work has are an error that names them (the first thousand)."""
    lost = [r.work_id for r in wanted.select("work_id").distinct().join(works.select("work_id"), "work_id", "left_anti").orderBy("work_id").limit(1000).collect()]
    if lost:
        raise LookupError(f"not found: {', '.join(lost)}")


def mark_manual(catalog: DataFrame, ids: DataFrame) -> DataFrame:
    """``catalog`` with the listed works selected by hand."""
    hit = catalog.join(ids.select("work_id").distinct().withColumn("__hit", F.lit(True)), "work_id", "left").withColumn("__hit", F.coalesce("__hit", F.lit(False)))
    return hit.withColumns({"method": F.when(F.col("__hit"), "manual").otherwise(F.col("method")), "selected": F.col("__hit") | F.col("selected")}).drop("__hit").select(*catalog.columns)


def add_works(catalog: DataFrame, snapshot: DataFrame, ids: DataFrame) -> DataFrame:
    """``catalog`` with the listed works, taken from ``snapshot`` where it lacks them; ids in neither are an error."""
    fresh = ids.select("work_id").distinct().join(catalog.select("work_id"), "work_id", "left_anti")
    require_found(fresh, snapshot)
    new = snapshot.join(fresh, "work_id", "left_semi").dropDuplicates(["work_id"])
    made = {"method": F.lit("manual"), "selected": F.lit(True), "processed": F.lit(False)}
    cols = [made.get(c, F.col(c) if c in new.columns else F.lit(None)).cast(catalog.schema[c].dataType).alias(c) for c in catalog.columns]
    return mark_manual(catalog, ids).unionByName(new.select(*cols))


def selected_sources(works: DataFrame, sources: DataFrame) -> DataFrame:
    """Records of the sources that selected works name, by the array ``sources`` of structs with an ``id``."""
    wanted = works.filter("selected").select(F.explode("sources.id").alias("source_id")).filter("source_id is not null").distinct()
    return sources.join(wanted, "source_id", "left_semi")


def screening_batches(works: DataFrame, order: list[str], size: int = 20) -> DataFrame:
    """Adds ``batch`` and the 1-based ``number`` inside it, in scan order."""
    numbered = running_counts(works, order, __n=F.lit(True))
    n = F.col("__n") - 1
    return numbered.withColumn("batch", F.floor(n / size).cast("long")).withColumn("number", (n % size + 1).cast("int")).drop("__n")


def screen(batched: DataFrame, screener, text_col: str = "text") -> DataFrame:
    """Rows that ``screener(texts) -> 1-based numbers`` selects in each batch; other numbers are refused."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("number")
        chosen = screener(list(pdf[text_col]))
        if any(isinstance(i, bool) or not isinstance(i, int) or not 1 <= i <= len(pdf) for i in chosen):
            raise ValueError("the screener chose a number outside the batch")
        return pdf[pdf["number"].isin(list(chosen))]

    return batched.groupBy("batch").applyInPandas(run, batched.schema)


def greedy_batches(docs: DataFrame, length: Column, limit: int, order: list[str], separator: int = 2, by: list[str] | None = None) -> DataFrame:
    """Adds ``batch``: rows in order are packed while their lengths and separators fit ``limit``.

    Rows are numbered over ranges of the order.  Packing itself is sequential: where a batch ends depends on
    all rows before it.  It folds over numbers and lengths alone, 16 bytes a row, once per group of ``by``;
    texts are never gathered.  A row above the limit is a batch of its own.
    """
    sized = docs.withColumn("__len", length.cast("long"))
    if by:
        numbered = sized.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    else:
        numbered = materialize(running_counts(sized, order, __n=F.lit(True)), "batch-rows")
    keys = [*(by or []), "__n"]

    def pack(batches):
        at, used, group = -1, 0, object()
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                if row[:-2] != group:
                    group, at, used = row[:-2], -1, 0
                size = row[-1]
                if at < 0 or used + separator + size > limit:
                    at, used = at + 1, size
                else:
                    used += separator + size
                out.append(at)
            yield pdf.drop(columns="__len").assign(batch=out)

    thin = numbered.select(*keys, "__len")
    ordered = thin.repartition(*by).sortWithinPartitions(*keys) if by else thin.coalesce(1).sortWithinPartitions("__n")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in thin.select(*keys).schema) + ", batch long"
    return numbered.join(ordered.mapInPandas(pack, schema), keys).drop("__n", "__len")


def upsert_works(old: DataFrame, new: DataFrame) -> DataFrame:
    """``(work_id, title, method, selected, processed)``: a manual selection stays, processing is untouched."""
    o = old.select(*[F.col(c).alias(f"o_{c}") for c in old.columns])
    j = o.join(new, o.o_work_id == new.work_id, "full_outer")
    sticky = F.coalesce(F.col("o_method") == "manual", F.lit(False)) & F.col("work_id").isNotNull()
    return j.select(
        F.coalesce("work_id", "o_work_id").alias("work_id"),
        F.when(F.col("work_id").isNull(), F.col("o_title")).otherwise(F.col("title")).alias("title"),
        F.when(sticky | F.col("work_id").isNull(), F.col("o_method")).otherwise(F.col("method")).alias("method"),
        F.when(sticky | F.col("work_id").isNull(), F.col("o_selected")).otherwise(F.col("selected")).alias("selected"),
        F.coalesce("o_processed", F.lit(False)).alias("processed"),
    )


def upsert_sources(old: DataFrame, new: DataFrame, order: str = "seq") -> DataFrame:
    """``(source_id, name, raw, is_full)``: a full record beats a partial one, later beats earlier, names persist."""
    both = old.unionByName(new).filter("source_id is not null")
    rank = F.struct(F.col("is_full").cast("int"), F.col(order))
    return both.groupBy("source_id").agg(F.max_by("name", F.when(F.col("name").isNotNull(), rank)).alias("name"), F.max_by("raw", rank).alias("raw"), F.max("is_full").alias("is_full"))


def materialization_plan(works: DataFrame, mode: str) -> DataFrame:
    """Adds ``action``: what each selected work needs in ``mode`` abstract, fulltext or fulltext-or-abstract."""
    has_abstract = F.length(F.trim(F.coalesce("abstract", F.lit("")))) > 0
    if mode == "abstract":
        action = F.when(F.col("abstract_processed"), "skip").when(has_abstract, "batch").otherwise("no_content")
    else:
        back = F.lit(mode == "fulltext-or-abstract") & has_abstract & ~F.col("abstract_processed")
        action = F.when(F.col("fulltext_processed"), "skip").when(F.col("fulltext").isNotNull(), "document").when(back, "batch").otherwise(F.coalesce("fulltext_status", F.lit("not_found")))
    return works.withColumn("action", action)


def abstract_section(work_id: Column, title: Column, doi: Column, abstract: Column) -> Column:
    return F.concat_ws("\n", F.concat(F.lit("[WORK "), work_id, F.lit("]")), F.concat(F.lit("Title: "), F.coalesce(title, F.lit(""))), F.concat(F.lit("DOI: "), F.coalesce(doi, F.lit(""))), F.trim(abstract), F.concat(F.lit("[/WORK "), work_id, F.lit("]")))


def fulltext_documents(works: DataFrame) -> DataFrame:
    """``(document_id, title, content, source_type, payload)`` of works with a full text; ``payload`` is JSON with provenance."""
    named = [c for c in ("work_id", "full_id", "title", "abstract", "doi", "year", "language", "type", "sources", "primary_source_id", "primary_source_name", "references") if c in works.columns]
    found = works.filter(F.length(F.trim(F.coalesce("fulltext", F.lit("")))) > 0)
    places = [F.struct(F.col("relative").alias("file"), "line").alias("snapshot_locator")] if {"relative", "line"} <= set(works.columns) else []
    payload = F.to_json(F.struct(F.col("work_id").alias("document_id"), *named[1:], F.col("fulltext").alias("content"), F.lit("fulltext").alias("content_mode"), F.lit("research").alias("source_type"), *places))
    return found.select(F.col("work_id").alias("document_id"), "title", F.col("fulltext").alias("content"), F.lit("research").alias("source_type"), payload.alias("payload"))


def abstract_documents(works: DataFrame, limit: int, order: list[str]) -> DataFrame:
    """One document per batch of abstracts: ``(document_id, title, content, source_type, work_ids)``.

    The id is made of 24 digits of the content's hash.  A batch holds at most ``limit`` characters, or one work.
    """
    section = abstract_section(F.col("work_id"), F.col("title"), F.col("doi"), F.col("abstract"))
    held = works.filter(F.length(F.trim(F.coalesce("abstract", F.lit("")))) > 0).withColumn("__section", section)
    batched = greedy_batches(held.select("work_id", *[c for c in order if c != "work_id"], "__section"), F.length("__section"), limit, order)
    items = F.array_sort(F.collect_list(F.struct(*order, F.col("work_id").alias("__id"), "__section")))
    packed = batched.groupBy("batch").agg(items.alias("items"))
    content = F.array_join(F.transform("items", lambda x: x["__section"]), "\n\n")
    out = packed.select(content.alias("content"), F.transform("items", lambda x: x["__id"]).alias("work_ids"))
    digest = F.substring(F.sha2("content", 256), 1, 24)
    return out.select(F.concat(F.lit("abstract-batch:"), digest).alias("document_id"), F.concat(F.lit("Abstract batch ("), F.size("work_ids").cast("string"), F.lit(" works)")).alias("title"), "content", F.lit("research").alias("source_type"), "work_ids")


def mark_materialized(catalog: DataFrame, done: DataFrame, kind: str) -> DataFrame:
    """``catalog`` with ``<kind>_path`` and ``<kind>_processed`` of the works in ``done`` (work_id, path, processed)."""
    path, flag = f"{kind}_path", f"{kind}_processed"
    base = catalog
    for name, empty in ((path, F.lit(None).cast("string")), (flag, F.lit(False))):
        base = base if name in base.columns else base.withColumn(name, empty)
    j = base.join(done.select("work_id", F.col("path").alias("__path"), F.col("processed").alias("__done")), "work_id", "left")
    return j.withColumns({path: F.coalesce("__path", path), flag: F.coalesce("__done", flag)}).select(*base.columns)


def log_run(runs: DataFrame, run_id: str, options: dict, started: str, finished: str | None = None, **counters: int) -> DataFrame:
    """``runs`` with one row more or, for a known id, the row replaced: options as JSON, times and counters."""
    import json

    row = (run_id, json.dumps(options, sort_keys=True), started, finished, {k: int(v) for k, v in counters.items()})
    new = runs.sparkSession.createDataFrame([row], RUNS)
    return runs.filter(F.col("run_id") != run_id).unionByName(new)


RUNS = "run_id string, options string, started string, finished string, counters map<string,bigint>"


def content_coverage(works: DataFrame) -> DataFrame:
    a = F.length(F.trim(F.coalesce("abstract", F.lit("")))) > 0
    f = F.coalesce("has_fulltext", F.lit(False))
    return works.agg(F.count("*").alias("selected"), F.count_if(a & f).alias("both"), F.count_if(a & ~f).alias("abstract_only"), F.count_if(~a & f).alias("fulltext_only"), F.count_if(~a & ~f).alias("neither"))
