"""File landing: discovery, parsing of texts, JSON and (optionally) PDF, and full texts."""

from __future__ import annotations

import io
import json
import os
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUFFIXES = (".txt", ".md", ".json", ".pdf")
# Suffixes of local full texts, the first that exists wins.
FULLTEXT_SUFFIXES = (".grobid-xml", ".xml", ".xml.gz", ".txt", ".md", ".json", ".pdf")
SOURCE_TYPES = ("textbook", "guidelines", "research")
LANDED = "document_id string, title string, content string, source_type string, path string, error string"


def discover(spark: SparkSession, root: str) -> DataFrame:
    """Supported files below ``root``, as binary rows; a single unsupported file is an error."""
    if not root.lower().endswith(SUFFIXES) and is_file(spark, root):
        raise ValueError(f"unsupported file {root}")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.filter(F.lower("path").rlike(r"\.(txt|md|json|pdf)$"))


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system that Spark can read is a file."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.exists(place) and system.getFileStatus(place).isFile()


def count(spark: SparkSession, root: str) -> int:
    return discover(spark, root).count()


def _pdf_text(data: bytes) -> str:
    try:
        from pypdf import PdfReader
    except ImportError as e:
        raise ValueError("PDF needs the optional package pypdf") from e
    return "\n\n".join(p.extract_text() or "" for p in PdfReader(io.BytesIO(data)).pages)


def parse_file(relative: str, data: bytes, default_type: str = "research") -> dict:
    """One document out of one file; ``error`` says why there is none."""
    stem, suffix = os.path.splitext(os.path.basename(relative))
    out = {"document_id": relative, "title": stem, "content": None, "source_type": default_type, "error": None}
    try:
        if suffix.lower() == ".pdf":
            out["content"] = _pdf_text(data)
        elif suffix.lower() == ".json":
            body = json.loads(data.decode("utf-8"))
            if isinstance(body, str):
                out["content"] = body
            elif isinstance(body, dict):
                out["content"] = body.get("content") or body.get("text")
                for key in ("document_id", "title", "source_type"):
                    out[key] = body.get(key) or out[key]
            else:
                raise ValueError("JSON must be a string or an object")
        else:
            out["content"] = data.decode("utf-8")
        if not (out["content"] or "").strip():
            raise ValueError("content is blank")
        if out["source_type"] not in SOURCE_TYPES:
            raise ValueError(f"unknown source type {out['source_type']}")
    except ValueError as e:
        out |= {"content": None, "error": str(e)}
    return out


def load_documents(spark: SparkSession, root: str, default_type: str = "research") -> DataFrame:
    """One row per supported file; ids are paths relative to ``root`` unless the file names its own."""
    base = re.sub(r"^[a-z]+:/*", "/", root).rstrip("/") + "/"

    def run(batches):
        for pdf in batches:
            rows = []
            for path, data in pdf.itertuples(index=False):
                plain = re.sub(r"^[a-z]+:/*", "/", path)
                rows.append({**parse_file(plain.removeprefix(base).lstrip("/"), data, default_type), "path": plain})
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in LANDED.split(", ")])

    return discover(spark, root).select("path", "content").mapInPandas(run, LANDED)


def fulltext_of(name: str, data: bytes) -> str | None:
    """Plain text of a full-text file; XML gives all its text nodes joined by blanks."""
    import gzip
    import xml.etree.ElementTree as ET

    low = name.lower()
    if low.endswith(".gz"):
        data, low = gzip.decompress(data), low[:-3]
    if low.endswith((".xml", ".grobid-xml")):
        return " ".join(t.strip() for t in ET.fromstring(data).itertext() if t.strip())
    if low.endswith(".json"):
        body = json.loads(data)
        return next((body[k] for k in ("full_text", "content", "text") if body.get(k)), None) if isinstance(body, dict) else body
    return _pdf_text(data) if low.endswith(".pdf") else data.decode("utf-8")


def local_fulltexts(spark: SparkSession, root: str, works: DataFrame) -> DataFrame:
    """``(work_id, path, fulltext)`` of the first local file of each work.

    Files are ``<id><suffix>`` in ``root`` or in a folder named like the id; suffixes go before layouts.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    base = re.sub(r"^[a-z0-9]+:/*", "/", root).rstrip("/") + "/"
    inside = F.replace(F.regexp_replace("path", r"^[a-z0-9]+:/*", "/"), F.lit(base), F.lit(""))
    leaf = F.substring_index("path", "/", -1)
    named = listing.select("path", inside.alias("inside"), F.regexp_extract(leaf, r"^([^.]+)\.", 1).alias("work_id"), F.lower(F.regexp_extract(leaf, r"^[^.]+(\..+)$", 1)).alias("suffix"), leaf.alias("leaf"))
    layout = F.when(F.col("inside") == F.col("leaf"), 0).when(F.col("inside") == F.concat_ws("/", "work_id", "leaf"), 1)
    ranked = named.withColumn("rank", F.array_position(F.array(*map(F.lit, FULLTEXT_SUFFIXES)), F.col("suffix"))).withColumn("layout", layout)
    ranked = ranked.filter("rank > 0 and layout is not null").join(works.select("work_id"), "work_id", "left_semi")
    best = ranked.groupBy("work_id").agg(F.min(F.struct("rank", "layout", "path")).alias("best"))
    chosen = listing.select("path", "content").join(best.select("work_id", F.col("best.path").alias("path")), "path")

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"work_id": pdf["work_id"], "path": pdf["path"], "fulltext": [fulltext_of(p, d) for p, d in zip(pdf["path"], pdf["content"])]})

    return chosen.mapInPandas(run, "work_id string, path string, fulltext string")
