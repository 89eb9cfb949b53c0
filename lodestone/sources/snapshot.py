"""Literature snapshots: gzip JSON lines in part files, listed by a manifest."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PART = r"^part_\d+\.gz$"
def manifest_parts(text: str) -> list[str]:
    """Paths, below whatever prefix, of the part files that a manifest names anywhere, in its order."""
    from urllib.parse import unquote, urlparse

    try:
        left = [json.loads(text)]
    except ValueError:
        return []
    found = []
    while left:
        value = left.pop()
        if isinstance(value, str):
            path = unquote(urlparse(value).path).replace("\\", "/")
            if re.match(PART, path.rsplit("/", 1)[-1]):
                found.append(path)
        elif isinstance(value, (dict, list)):
            left += reversed(list(value.values() if isinstance(value, dict) else value))
    return list(dict.fromkeys(found))


def part_files(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """``(path, relative, bytes)`` of the parts of an entity, in ``root/data``, ``root`` or ``root/data/jsonl``.

    A manifest decides which parts count: those whose path below the entity ends one that it names.  If
    it cannot be parsed, or names none of the files, all files named like parts count.
    """
    top = root.rstrip("/")
    bases = [f"{d}/{entity}" for d in (f"{top}/data", top, f"{top}/data/jsonl")]
    base = next((b for b in bases if _exists(spark, b)), None)
    if base is None:
        raise FileNotFoundError(f"no folder {entity} below {root}")
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base).select("path", F.col("length").alias("bytes"))
    parts = listing.filter(F.regexp_extract("path", r"([^/]+)$", 1).rlike(PART))
    parts = parts.withColumn("relative", F.substring_index("path", f"/{base.rsplit('/', 1)[-1]}/", -1)).select("path", "relative", "bytes")
    if not _exists(spark, f"{base}/manifest"):
        return parts
    named = manifest_parts(spark.read.text(f"{base}/manifest", wholetext=True).first()[0])
    if not named:
        return parts
    # A part is named if some suffix of a named path is its relative path; suffixes make that an equality.
    suffixes = {"/".join(steps[i:]) for steps in (n.split("/") for n in named) for i in range(len(steps))}
    wanted = spark.createDataFrame([(x,) for x in sorted(suffixes)], "relative string")
    matched = parts.join(wanted, "relative", "left_semi").select(*parts.columns)
    return parts if matched.isEmpty() else matched


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def compressed_size(parts: DataFrame) -> DataFrame:
    return parts.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


SCANNED = "relative string, line long, record string, error string, message string, records_read long"


def _opened(path: str):
    """A part as a byte stream; file systems that only Spark can open give their parts as a binary column."""
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", re.sub("^s3a:", "s3:", path)))
    return store.open_input_stream(name, compression=None)


def _records(relative: str, stream, strict: bool):
    import gzip

    line = read = 0
    try:
        with gzip.open(stream, "rt", encoding="utf-8") as f:
            for text in f:
                line += 1
                if text.strip():
                    if not isinstance(json.loads(text), dict):
                        raise ValueError("a record is no object")
                    read += 1
                    yield relative, line, text.strip(), None, None, None
    except (EOFError, OSError, ValueError) as e:
        if strict:
            raise
        yield relative, None, None, type(e).__name__, str(e), read


def _frames(rows, most: int = 5000):
    names = [f.split()[0] for f in SCANNED.split(", ")]
    whole = {"line": "Int64", "records_read": "Int64"}
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pd.DataFrame(held, columns=names).astype(whole)
            held = []
    if held:
        yield pd.DataFrame(held, columns=names).astype(whole)


def scan(spark: SparkSession, parts: DataFrame, strict: bool = False) -> DataFrame:
    """Rows of all parts: a record with its file and 1-based line, or a failure.

    Records before a fault are kept, the rest of that part is dropped and one row with ``error`` tells
    how many were read.  Blank lines are skipped but counted.  Parts are gzip and cannot be split, so
    each is read by one task, as a stream where the tasks can open the file system; elsewhere a part is
    held whole, up to the 2 GB of a binary column.
    """
    import io

    first = parts.select("path").first()
    if first is None:
        return spark.createDataFrame([], SCANNED)
    if re.match(r"(file|hdfs|s3a?|gs|abfss?):", first.path):

        def stream(batches):
            for pdf in batches:
                for path, relative in pdf.itertuples(index=False):
                    with _opened(path) as opened:
                        yield from _frames(_records(relative, opened, strict))

        # One part a task: names are few, records many.
        tasks = max(1, min(parts.count(), 100_000))
        return parts.select("path", "relative").repartition(tasks, "path").mapInPandas(stream, SCANNED)

    def whole(batches):
        for pdf in batches:
            for relative, data in pdf.itertuples(index=False):
                yield from _frames(_records(relative, io.BytesIO(data), strict))

    chosen = [r.path for r in parts.select("path").collect()]  # file names only, as Spark's own listing holds them
    files = spark.read.format("binaryFile").load(chosen).join(parts.select("path", "relative"), "path")
    return files.select("relative", "content").mapInPandas(whole, SCANNED)


def failures(scanned: DataFrame) -> DataFrame:
    return scanned.filter("error is not null").select("relative", "error", "message", "records_read")


def work_id(value: Column) -> Column:
    """The last path segment in upper case if it is ``W`` and digits, else null."""
    last = F.upper(F.substring_index(F.regexp_replace(value, "/+$", ""), "/", -1))
    return F.when(last.rlike(r"^W\d+$"), last)


def field_id(value: Column) -> Column:
    """A positive number, by itself or at the end of a path below ``fields``; else null."""
    text = F.trim(value.cast("string"))
    number = F.regexp_extract(text, r"(?i)^(?:.*/)?fields/(\d+)/?$|^(\d+)$", 1)
    number = F.when(number != "", number).otherwise(F.regexp_extract(text, r"^(\d+)$", 1))
    found = F.nullif(number, F.lit("")).try_cast("int")
    return F.when(found > 0, found)


def field_ids(topics: Column) -> Column:
    """Distinct fields of topics given as JSON, whose field is a number, a text or an object with an id."""
    raw = F.transform(topics, lambda t: F.coalesce(F.get_json_object(t, "$.field.id"), F.get_json_object(t, "$.field")))
    kind = F.transform(raw, lambda x: F.when(~x.isin("true", "false"), x))
    return F.array_distinct(F.filter(F.transform(kind, field_id), lambda x: x.isNotNull()))


def _named(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it: the element of a one-element array."""
    return F.element_at(F.transform(F.array(value), f), 1)


def invert_abstract(words: Column) -> Column:
    """Inverted index of an array of words: the positions of each distinct word; made in the row, whatever its id."""
    # Equal words stand side by side after the sort; every start of such a run knows where the run ends.
    placed = F.sort_array(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at"))))
    starts = lambda o: F.filter(F.transform(o, lambda x, i: i), lambda i: (i == 0) | (F.get(o, i - 1)["word"] != F.get(o, i)["word"]))
    run = lambda o, s, i, n: F.struct(F.get(o, i)["word"].alias("word"), F.transform(F.slice(o, i + 1, F.coalesce(F.get(s, n + 1), F.size(o)) - i), lambda e: e["at"]).alias("at"))
    return F.map_from_entries(_named(placed, lambda o: _named(starts(o), lambda s: F.transform(s, lambda i, n: run(o, s, i, n)))))


def restore_abstract(index: Column) -> Column:
    """Text of an inverted index: words by position, the first word wins a position, gaps are skipped; null if empty."""
    entries = F.flatten(F.transform(F.map_entries(index), lambda e, i: F.transform(F.filter(e.value, lambda p: p >= 0), lambda p: F.struct(p.alias("at"), i.alias("nth"), e.key.alias("word")))))
    first = _named(F.sort_array(entries), lambda o: F.filter(o, lambda x, i: (i == 0) | (F.get(o, i - 1)["at"] != x["at"])))
    return _named(F.array_join(F.transform(first, lambda x: x["word"]), " "), lambda text: F.nullif(text, F.lit("")))


WORK = (
    "id string, doi string, title string, display_name string, abstract_inverted_index map<string,array<int>>, publication_year string, language string, "
    "type string, has_fulltext string, has_content string, content_urls map<string,string>, primary_location string, best_oa_location string, "
    "locations array<string>, referenced_works array<string>, primary_topic string, topics array<string>"
)


def _json(value: Column, path: str) -> Column:
    """A text member of a JSON column; blank counts as absent."""
    return F.nullif(F.get_json_object(value, f"$.{path}"), F.lit(""))


def works(scanned: DataFrame, max_works: int | None = None) -> DataFrame:
    """Parsed works with a valid id, in scan order up to ``max_works``.

    Members of another type than expected count as absent, as in a work without them.
    """
    w = scanned.filter("record is not null").withColumn("w", F.from_json("record", WORK, {"mode": "PERMISSIVE"})).withColumn("work_id", work_id(F.col("w.id"))).filter("work_id is not null")
    c = lambda name: F.col(f"w.{name}")
    none = F.array().cast("array<string>")
    primary = c("primary_location")
    places = F.filter(F.concat(F.array(primary), F.coalesce(c("locations"), none)), lambda x: x.isNotNull())
    source = lambda x: F.struct(_json(x, "source.id").alias("id"), _json(x, "source.display_name").alias("display_name"), _json(x, "source.type").alias("type"), F.get_json_object(x, "$.source").alias("raw"))
    key = lambda s: F.coalesce(s["id"], s["display_name"])
    listed = F.filter(F.transform(places, source), lambda s: key(s).isNotNull())
    sources = F.filter(listed, lambda s, i: ~F.exists(F.slice(listed, F.lit(1), i), lambda other: key(other) == key(s)))
    links = F.transform(F.filter(F.concat(F.array(c("best_oa_location")), places), lambda x: x.isNotNull()), lambda x: _json(x, "pdf_url"))
    urls = F.array_distinct(F.filter(F.concat(F.coalesce(F.map_values(c("content_urls")), none), links), lambda u: u.isNotNull() & (u != "")))
    # has_content is true, or an object with any true member.
    hinted = (c("has_fulltext") == "true") | (c("has_content") == "true") | F.coalesce(c("has_content").rlike(r":\s*true"), F.lit(False))
    has = lambda name: F.coalesce(F.get_json_object(c("has_content"), f"$.{name}") == "true", F.lit(False))
    year = F.when(c("publication_year").rlike(r"^-?\d+$"), c("publication_year").try_cast("int"))
    blank = lambda x: F.nullif(x, F.lit(""))
    out = w.select(
        "work_id", c("id").alias("full_id"), "relative", "line", F.trim(F.coalesce(blank(c("title")), blank(c("display_name")), F.lit(""))).alias("title"),
        restore_abstract(c("abstract_inverted_index")).alias("abstract"), blank(c("doi")).alias("doi"), year.alias("year"), blank(c("language")).alias("language"), blank(c("type")).alias("type"),
        field_ids(F.filter(F.concat(F.array(c("primary_topic")), F.coalesce(c("topics"), none)), lambda t: t.isNotNull())).alias("fields"),
        sources.alias("sources"), _json(primary, "source.id").alias("primary_source_id"), _json(primary, "source.display_name").alias("primary_source_name"),
        (F.coalesce(hinted, F.lit(False)) | (F.size(urls) > 0)).alias("has_fulltext"), has("grobid_xml").alias("has_xml"), has("pdf").alias("has_pdf"), urls.alias("fulltext_urls"),
        F.coalesce(c("referenced_works"), none).alias("references"), F.col("record").alias("raw"),
    )
    return out if max_works is None else out.orderBy("relative", "line").limit(max_works)
