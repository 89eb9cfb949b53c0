"""Property-graph export and lookups: row nodes, foreign-key edges, graph views, and file sinks."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.hashing import row_key


@dataclass(frozen=True)
class ForeignKey:
    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


def label(table: str) -> str:
    """``SQL_`` and the table name with odd characters as underscores; a leading digit gets ``T_``."""
    clean = re.sub(r"[^0-9A-Za-z]", "_", table)
    return "SQL_" + (f"T_{clean}" if clean[:1].isdigit() else clean)


def nodes(tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    """``(node_key, label, kind, properties)`` of every row of every table; properties are JSON."""
    out = None
    for name, df in tables.items():
        part = df.select(row_key(name, keys[name]).alias("node_key"), F.lit(label(name)).alias("label"), F.lit(name).alias("kind"), F.to_json(F.struct(*df.columns)).alias("properties"))
        out = part if out is None else out.unionByName(part)
    return out


def foreign_key_edges(tables: dict[str, DataFrame], keys: dict[str, list[str]], references: list[ForeignKey]) -> DataFrame:
    """``(source_key, target_key, relation)`` of every reference that has its parent."""
    out = None
    for ref in references:
        child, parent = tables[ref.child], tables[ref.parent]
        ends = child.select(row_key(ref.child, keys[ref.child]).alias("source_key"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(ref.columns)])
        heads = parent.select(row_key(ref.parent, keys[ref.parent]).alias("target_key"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(ref.parent_columns)])
        part = ends.join(heads, [f"k{i}" for i in range(len(ref.columns))]).select("source_key", "target_key", F.lit("_".join((ref.child, *ref.columns))).alias("relation"))
        out = part if out is None else out.unionByName(part)
    return out


def projected_edges(facts: DataFrame, entities: DataFrame, links: DataFrame) -> DataFrame:
    """Facts between known entities with the number of their evidence rows."""
    ends = lambda c: entities.select(F.col("entity_id").alias(c), F.col("name").alias(f"{c}_name"))
    counted = links.groupBy("identity").agg(F.count("*").alias("evidence_count"))
    return facts.join(ends("subject_entity"), "subject_entity").join(ends("object_entity"), "object_entity").join(counted, "identity", "left").withColumn("evidence_count", F.coalesce("evidence_count", F.lit(0)))


def view_filter(edges: DataFrame, mode: str) -> DataFrame:
    """``raw`` edges, ``all`` edges, or the canonical ones for any other mode."""
    if mode == "all":
        return edges
    return edges.filter(F.col("layer") == ("raw" if mode == "raw" else "canonical"))


def web_nodes(node_table: DataFrame) -> DataFrame:
    """``(id, label, kind, properties)``: the first telling property names a node, its type is its kind."""
    p = lambda name: F.nullif(F.get_json_object("properties", f"$.{name}"), F.lit(""))
    # Properties that name a node, in this order.
    names = ("canonical_name", "mention_text", "title", "canonical_relation", "name")
    return node_table.select(F.col("node_key").alias("id"), F.coalesce(*map(p, names), "kind").alias("label"), F.coalesce(p("entity_type"), "kind").alias("kind"), "properties")


def graph_view(node_table: DataFrame, edges: DataFrame, mode: str = "canonical", limit: int = 500) -> tuple[DataFrame, DataFrame]:
    """Edges of a mode up to the limit (1 to 5000) with their nodes; ``all`` fills up to the limit with other nodes."""
    limit = max(1, min(5000, limit))
    shown = view_filter(edges, mode).orderBy("edge_key").limit(limit)
    ends = shown.select(F.col("source_key").alias("node_key")).unionByName(shown.select(F.col("target_key").alias("node_key"))).distinct()
    seen = node_table.join(ends, "node_key", "left_semi")
    if mode == "all" and (n := ends.count()) < limit:
        seen = seen.unionByName(node_table.join(ends, "node_key", "left_anti").orderBy("node_key").limit(limit - n))
    return seen, shown


def network_view(nodes: DataFrame, edges: DataFrame, limit: int = 500) -> tuple[DataFrame, DataFrame]:
    """The first edges of a layered network, by their ends, and the nodes at them."""
    shown = edges.orderBy("source_node", "target_node").limit(max(1, min(5000, limit)))
    ends = shown.select(F.col("source_node").alias("node_id")).unionByName(shown.select(F.col("target_node").alias("node_id"))).distinct()
    return nodes.join(ends, "node_id", "left_semi"), shown


def merge_nodes(old: DataFrame, new: DataFrame, key: str = "node_key") -> DataFrame:
    """``new`` in place of the nodes with the same key; a node is replaced whole."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def delete_rows(table: DataFrame, doomed: DataFrame, keys: list[str]) -> DataFrame:
    """``table`` without the rows whose key is in ``doomed``."""
    return table.join(doomed.select(*keys).distinct(), keys, "left_anti")


def property_value(value: Column, kind: str) -> Column:
    """A column as a graph property: bytes as ``base64:`` text, nested values as JSON, the rest as it is."""
    if kind == "binary":
        return F.concat(F.lit("base64:"), F.base64(value))
    return F.to_json(value) if kind.startswith(("array", "map", "struct")) else value


def null_columns(df: DataFrame) -> Column:
    """JSON list of the columns that are null in a row."""
    return F.to_json(F.filter(F.array(*[F.when(F.col(f"`{c}`").isNull(), F.lit(c)) for c in df.columns]), lambda x: x.isNotNull()))


def inspect(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table, rows, columns)`` of every table."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).cast("long").alias("n_columns"))
        out = part if out is None else out.unionByName(part)
    return out


def describe(tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    """``(table_name, position, column, type, key_position)`` of every column; 0 is no key column."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(t, i, f.name, f.dataType.simpleString(), (list(keys.get(t, ())) + [f.name]).index(f.name) + 1 if f.name in keys.get(t, ()) else 0) for t, df in tables.items() for i, f in enumerate(df.schema)]
    return spark.createDataFrame(rows, "table_name string, position int, column string, type string, key_position int")


def sample_rows(tables: dict[str, DataFrame], n: int = 3) -> DataFrame:
    """``(table_name, row)``: up to ``n`` rows of each table as JSON, without reading more than they need."""
    out = None
    for name, df in tables.items():
        part = df.limit(n).select(F.lit(name).alias("table_name"), F.to_json(F.struct(*df.columns)).alias("row"))
        out = part if out is None else out.unionByName(part)
    return out


def references(declared: list[tuple], tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> list[ForeignKey]:
    """Foreign keys from ``(child, columns, parent[, parent columns])``: the parent's key by default, unknown parents skipped."""
    made = [ForeignKey(d[0], tuple(d[1]), d[2], tuple(d[3] if len(d) > 3 and d[3] else keys.get(d[2], ()))) for d in declared]
    return [r for r in made if r.parent in tables and r.child in tables and len(r.columns) == len(r.parent_columns)]


def show(table: DataFrame, key: str, value: str) -> dict | None:
    """One row by its key as a dictionary, JSON columns decoded; None if there is none."""
    row = table.filter(F.col(key) == value).first()
    if row is None:
        return None
    out = row.asDict(recursive=True)
    for name, x in out.items():
        if name.endswith("_json") and x:
            out[name] = json.loads(x)
    return out


def write_text(spark, path: str, text: str) -> None:
    """A small file on any file system of Spark, put in place by a rename."""
    jvm = spark.sparkContext._jvm
    place, part = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = system.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    system.delete(place, False)
    if not system.rename(part, place):
        raise OSError(f"cannot put {path} in place")


def write_manifest(spark, path: str, facts: dict) -> None:
    """A JSON file with sorted keys."""
    write_text(spark, path, json.dumps(facts, sort_keys=True, indent=2, ensure_ascii=False) + "\n")


def yaml_text(value, depth: int = 0) -> str:
    """Block YAML of dictionaries, lists and plain values; texts are quoted as in JSON."""
    pad = "  " * depth
    if isinstance(value, dict) and value:
        return "".join(f"{pad}{k}:" + (f"\n{yaml_text(v, depth + 1)}" if isinstance(v, (dict, list)) and v else f" {yaml_text(v)}\n") for k, v in value.items())
    if isinstance(value, list) and value:
        return "".join(f"{pad}-\n{yaml_text(v, depth + 1)}" if isinstance(v, (dict, list)) and v else f"{pad}- {yaml_text(v)}\n" for v in value)
    return json.dumps(value, ensure_ascii=False)


def write_descriptor(spark, path: str, name: str, files: dict[str, str], settings: dict) -> None:
    """A YAML file that names the tables of a graph and the settings they were built with."""
    write_text(spark, path, yaml_text({"name": name, "files": files, "settings": settings}))


def write_tsv(df: DataFrame, path: str, order: list[str] | None = None, one_file: bool = True) -> None:
    """Header and tab-separated rows, sorted by ``order``; booleans in lower case, doubles in six significant digits.

    ``one_file`` sorts in ranges and then writes them, in order, through a single task.
    """
    from lodestone.functions.text import six_digits

    ordered = df.orderBy(*order) if order else df
    cols = [six_digits(F.col(f"`{f.name}`")).alias(f.name) if f.dataType.typeName() in ("double", "float") else F.col(f"`{f.name}`").cast("string").alias(f.name) for f in df.schema]
    out = ordered.select(*cols)
    (out.coalesce(1) if one_file else out).write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").csv(path)


def read_tsv(spark, path: str, booleans: tuple[str, ...] = (), integers: tuple[str, ...] = (), confidence: str | None = None) -> DataFrame:
    """Typed TSV: true, 1 and yes are true; a blank confidence is 1."""
    df = spark.read.option("sep", "\t").option("header", True).csv(path)
    made = {c: F.lower(F.coalesce(c, F.lit(""))).isin("true", "1", "yes") for c in booleans}
    made |= {c: F.expr(f"try_cast(`{c}` as int)") for c in integers}
    if confidence:
        made[confidence] = F.coalesce(F.expr(f"try_cast(`{confidence}` as double)"), F.lit(1.0))
    return df.withColumns(made)


def write_subgraph(nodes: DataFrame, edges: DataFrame, path: str, facts: dict | None = None) -> None:
    """Nodes and edges as zstd Parquet and as CSV, and ``summary.json`` with their counts."""
    counts = {}
    for name, df in (("nodes", nodes), ("edges", edges)):
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/{name}.parquet")
        written = df.sparkSession.read.parquet(f"{path}/{name}.parquet")
        flat = written.select(*[F.to_json(f"`{f.name}`").alias(f.name) if f.dataType.typeName() in ("array", "map", "struct") else F.col(f"`{f.name}`") for f in written.schema])
        flat.write.mode("overwrite").option("header", True).csv(f"{path}/{name}.csv")
        kind = "type" if name == "nodes" else "edge_type"
        by = [c for c in (kind, "hop") if c in written.columns]
        counts[name] = {"total": written.count()} | ({"groups": [r.asDict() for r in written.groupBy(*by).count().orderBy(*by).limit(10_000).collect()]} if by else {})
    write_manifest(nodes.sparkSession, f"{path}/summary.json", counts | (facts or {}))
