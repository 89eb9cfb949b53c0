"""Character chunks with overlap, extraction output, and its validation."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.text import mention_offset, offset_of
from lodestone.operators.layered import in_blocks
from lodestone.operators.skew import counted_join, salted_join
from lodestone.session import materialize


def chunk_spans(content: Column, size: int | None, overlap: int = 0) -> Column:
    """Array of ``(index, start, stop)``; steps of ``size - overlap``, the last chunk ends with the text."""
    n = F.length(content)
    if size is None:
        return F.array(F.struct(F.lit(0).alias("index"), F.lit(0).alias("start"), n.alias("stop")))
    if size < 1 or overlap < 0 or overlap >= size:
        raise ValueError("size must be positive and overlap in [0, size)")
    step = size - overlap
    last = F.greatest(F.lit(0), F.ceil((n - size) / step)).cast("int")
    spans = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(i.alias("index"), (i * step).alias("start"), F.least(i * step + size, n).alias("stop")))
    return F.when(n > 0, spans)


def chunk_documents(docs: DataFrame, size: int | None, overlap: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    spans = docs.select(id_col, text_col, F.explode(chunk_spans(F.col(text_col), size, overlap)).alias("s"))
    return spans.select(id_col, F.col("s.index").alias("chunk_index"), F.col("s.start").alias("start"), F.col("s.stop").alias("stop"), F.substring(text_col, F.col("s.start") + 1, F.col("s.stop") - F.col("s.start")).alias("chunk"))


def evidence_validated(content: Column, evidence: Column) -> Column:
    return F.coalesce(F.contains(content, evidence), F.lit(False))


def _inner_words(text: Column, n: int) -> Column:
    """Hashes of the runs of ``n`` words of a text."""
    words = F.filter(F.split(text, WHITE), lambda w: w != "")
    at = lambda o: F.sequence(F.lit(1), F.greatest(F.size(o) - (n - 1), F.lit(1)))
    runs = lambda o: F.when(F.size(o) >= n, F.transform(at(o), lambda i: F.xxhash64(F.array_join(F.slice(o, i, F.lit(n)), " "))))
    # The one-element array names the words once, so the text is not split again per run.
    return F.element_at(F.transform(F.array(words), runs), 1)


WHITE = r"[\x20\x09-\x0D]+"


def find_passages(docs: DataFrame, passages: DataFrame, id_col: str, passage_id: str, text_col: str = "text", passage_col: str = "passage", inner: int = 3) -> DataFrame:
    """``(passage_id, id, offset)`` of every document row that holds a passage as a substring.

    Where a passage stands, the words inside it stand whole and in the same order, so a run of ``inner`` of
    them, neither the first nor the last, must be among the document's.  Documents and passages meet on the
    hash of that run, and what meets is verified on the texts.  Passages with fewer words are searched in
    every document, in blocks.
    """
    docs = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).filter("__text is not null")
    p = passages.select(F.col(passage_id).alias("__item"), F.col(passage_col).alias("__passage")).filter("__passage is not null")
    words = F.filter(F.split("__passage", WHITE), lambda w: w != "")
    p = p.withColumn("__run", F.when(F.size(words) >= inner + 2, F.xxhash64(F.array_join(F.slice(words, 2, inner), " "))))
    p = materialize(p, "passages")
    anchored = p.filter("__run is not null")
    met = None
    if not anchored.isEmpty():
        keys = anchored.select("__run").distinct()
        # Hashes and runs are made below the explosion, so no text is copied or hashed per run; an outer one has no filter that makes the runs again.
        hashed = docs.select("__id", F.sha2("__text", 256).alias("__sha"), F.array_distinct(_inner_words(F.col("__text"), inner)).alias("__runs"))
        thin = counted_join(hashed.select("__id", "__sha", F.explode_outer("__runs").alias("__run")), keys, ["__run"], F.xxhash64("__id"), "inner", 1_000_000)
        # Few documents hold a run, so texts are joined to those alone.
        pairs = materialize(salted_join(thin, anchored.select("__run", "__item", "__passage"), ["__run"], F.xxhash64("__id")).select("__sha", "__item", "__passage").distinct(), "passage-pairs")
        keyed = docs.withColumn("__sha", F.sha2("__text", 256))
        met = counted_join(keyed, pairs, ["__sha"], F.xxhash64("__id")).filter(F.contains("__text", "__passage")).select("__item", "__id", "__text", "__passage")
    short = p.filter("__run is null").select("__item", "__passage")
    for block in in_blocks(short, 1_000):
        part = docs.join(F.broadcast(block), F.contains("__text", "__passage")).select("__item", "__id", "__text", "__passage")
        met = part if met is None else met.unionByName(part)
    if met is None:
        met = p.join(docs, F.lit(False)).select("__item", "__id", "__text", "__passage")
    return met.select(F.col("__item").alias(passage_id), F.col("__id").alias(id_col), offset_of(F.col("__text"), F.col("__passage")).alias("offset"))


def extraction_violations(subject: Column, object_: Column, relation: Column, evidence: Column, confidence: Column, entity_type: Column, detail: Column) -> Column:
    """Array of broken rules of one extracted assertion."""
    blank = lambda c: F.coalesce(F.length(F.trim(c)) == 0, F.lit(True))
    rules = [("subject", blank(subject)), ("object", blank(object_)), ("relation", blank(relation)), ("evidence", blank(evidence)), ("confidence", ~F.coalesce(confidence.between(0, 1), F.lit(False))), ("detail", (entity_type == "OTHER") & blank(detail))]
    return F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules]), lambda x: x.isNotNull())


def distinct_assertions(assertions: DataFrame, document: str = "document_id", body: str = "assertion", order: tuple[str, ...] = ("chunk_index", "position")) -> DataFrame:
    """First of equal assertions of a document, over its chunks."""
    return assertions.groupBy(document, F.sha2(body, 256).alias("assertion_key")).agg(F.min_by(body, F.struct(*order)).alias(body), *[F.min(F.struct(*order))[c].alias(c) for c in order])


def extract(chunks: DataFrame, extractor: Callable[[str], list[dict]], schema: str) -> DataFrame:
    """Runs a model over chunks, an Arrow batch at a time; ``extractor`` returns rows of ``schema``."""
    fields = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [{**key, **row} for *key_, text in pdf.itertuples(index=False) for key in [dict(zip(pdf.columns, key_))] for row in extractor(text)]
            yield pd.DataFrame(rows, columns=[*pdf.columns[:-1], *fields])

    keys = [f for f in chunks.schema if f.name != "chunk"]
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys)
    return chunks.select(*[f.name for f in keys], "chunk").mapInPandas(run, f"{head}, {schema}")


def offline_extractor(text: str) -> list[dict]:
    """A deterministic stand-in for a model: ``A <verb> B.`` sentences of three words."""
    out = []
    for sentence in text.split("."):
        words = sentence.split()
        if len(words) == 3:
            out.append({"subject": words[0], "relation": words[1], "object": words[2], "evidence": sentence.strip(), "confidence": 0.5})
    return out


def persist(extracted: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(mentions, assertions)`` of extraction rows ``(document_id, subject, subject_type, relation, object, object_type, evidence, confidence)``.

    Repeated assertions of a document count once.  Mentions carry the character span of their place in the
    document, inside the evidence where that stands in it; assertions say whether it does.  Ids are hashes
    of what identifies a row, so a second run makes the same rows.
    """
    body = F.to_json(F.struct("subject", "subject_type", "relation", "object", "object_type", "evidence"))
    order = F.struct(*[c for c in ("chunk_index", "position") if c in extracted.columns], "confidence")
    once = extracted.withColumn("__body", body).withColumn("__order", order)
    keep = ["subject", "subject_type", "relation", "object", "object_type", "evidence", "confidence"]
    once = once.groupBy("document_id", F.sha2("__body", 256).alias("__key")).agg(F.min_by(F.struct(*keep), "__order").alias("r")).select("document_id", "__key", "r.*")
    hashed = lambda *cols: F.sha2(F.concat_ws("\x01", *cols), 256)
    once = once.withColumns({f"{end}_mention": hashed("document_id", "__key", F.lit(end)) for end in ("subject", "object")})
    placed = once.join(docs.select(F.col("document_id"), F.col("content")), "document_id", "left")
    ends = None
    for end in ("subject", "object"):
        start = mention_offset(F.col("content"), F.col("evidence"), F.col(end))
        part = placed.select(F.col(f"{end}_mention").alias("mention_id"), "document_id", F.col(end).alias("mention_text"), F.col(f"{end}_type").alias("entity_type"), start.alias("character_start"), (start + F.length(end)).alias("character_end"))
        ends = part if ends is None else ends.unionByName(part)
    assertions = placed.select(
        hashed("document_id", "__key").alias("raw_id"), "document_id", "subject_mention", "object_mention", F.col("relation").alias("phrase"), F.col("evidence").alias("evidence_text"), "confidence", evidence_validated(F.col("content"), F.col("evidence")).alias("evidence_validated")
    )
    return ends, assertions
