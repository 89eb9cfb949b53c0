"""Identifiers and canonical JSON as Column expressions."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions.text import alias_key, search_text

# Qualifiers that describe the evidence and not the fact.
EVIDENCE_QUALIFIERS = ("effect_size", "statistical_significance", "study_type")


def content_hash(value: Column) -> Column:
    return F.sha2(value, 256)


def entity_id(entity_type: Column, name: Column) -> Column:
    """``ENT_`` and 20 hex digits of the type and the normalized name."""
    return F.concat(F.lit("ENT_"), F.upper(F.substring(F.sha2(F.concat(entity_type, F.decode(F.unhex(F.lit("00")), "UTF-8"), alias_key(name)), 256), 1, 20)))


def json_string(value: Column) -> Column:
    """A JSON string literal with the mandatory escapes, control characters in lower-case hex."""
    literal = F.to_json(F.struct(value.alias("v")))
    out = F.substring(literal, F.lit(6), F.length(literal) - 6)
    fixed = out
    for code in (0x0B, 0x0E, 0x0F, *range(0x1A, 0x20)):
        fixed = F.regexp_replace(fixed, rf"(?<!\\)((?:\\\\)*)\\u{code:04X}", rf"$1\\u{code:04x}")
    plain = F.concat(F.lit('"'), value, F.lit('"'))
    return F.when(value.isNull(), F.lit(None).cast("string")).when(~value.rlike(r'["\\\x00-\x1F]'), plain).otherwise(F.when(value.rlike(r"[\x0B\x0E\x0F\x1A-\x1F]"), fixed).otherwise(out))


def canonical_qualifiers(qualifiers: Column) -> Column:
    """Sorted JSON of a string map without evidence-level and blank entries, values folded."""
    kept = F.map_filter(qualifiers, lambda k, v: ~k.isin(*EVIDENCE_QUALIFIERS))
    entries = F.transform(F.map_entries(kept), lambda e: F.struct(e.key.alias("key"), search_text(e.value).alias("value")))
    entries = F.sort_array(F.filter(entries, lambda e: e.value != ""))
    pairs = F.transform(entries, lambda e: F.concat(json_string(e.key), F.lit(":"), json_string(e.value)))
    return F.coalesce(F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}")), F.lit("{}"))


_NOTHING = (None, "", [], {})


def _compact_json(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _entry(value):
    """A value as it stands in an object or list; objects inside it were made by ``_object`` already."""
    if isinstance(value, list):
        return sorted((e for e in map(_entry, value) if e not in _NOTHING), key=lambda e: json.dumps(e, sort_keys=True, ensure_ascii=False))
    return " ".join(value.split()).casefold() if isinstance(value, str) else value


def _object(pairs: list[tuple[str, object]]) -> dict:
    """Called by the parser for every object, innermost first."""
    return {k: e for k, v in pairs if (e := _entry(v)) not in _NOTHING}


@F.pandas_udf(T.StringType())
def nested_qualifiers(values: pd.Series) -> pd.Series:
    """Canonical JSON of qualifiers given as a JSON object of any depth; null counts as empty."""

    def one(text: str | None) -> str:
        kept = json.loads(text, object_pairs_hook=_object) if text else {}
        return _compact_json({k: v for k, v in kept.items() if k not in EVIDENCE_QUALIFIERS})

    return values.map(one)


def assertion_identity(subject: Column, relation: Column, object_: Column, qualifiers: Column, negated: Column, speculative: Column) -> Column:
    """SHA-256 of the compact JSON of a fact with sorted keys; ``qualifiers`` is canonical JSON."""
    flag = lambda c: F.when(c, "true").otherwise("false")
    parts = [
        F.lit('{"negated":'), flag(negated), F.lit(',"object":'), json_string(object_), F.lit(',"qualifiers":'), qualifiers,
        F.lit(',"relation":'), json_string(relation), F.lit(',"speculative":'), flag(speculative), F.lit(',"subject":'), json_string(subject), F.lit("}"),
    ]
    return F.sha2(F.concat(*parts), 256)


def row_key(table: str, columns: list[str]) -> Column:
    """``table:`` and the compact JSON of the key columns, the node id of a relational row."""
    return F.concat(F.lit(f"{table}:"), F.to_json(F.struct(*columns)))


def percent_encoded(value: Column) -> Column:
    """URL quoting that leaves letters, digits and ``-._~`` as they are."""
    return F.replace(F.replace(F.replace(F.url_encode(value), F.lit("+"), F.lit("%20")), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))
