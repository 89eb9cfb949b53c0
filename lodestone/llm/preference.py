"""Preference formatting of paired conversations, in DataFrame operations only.

A pair has a chosen and a rejected conversation.  Their longest common turn prefix, in order of
``turn``, is rendered once as the prompt; what follows on either side is rendered as its completion,
masked so that only assistant turns are trained on.

:func:`format_pairs` renders turns, one row each: turns of the two sides meet by pair and turn number,
the first turn that differs is a minimum over the pair, and it comes back to the turns in a salted join,
so no task holds a whole conversation.  :func:`assemble` puts them together as pairs, one row per pair
and part: a part covers ``part_turns`` turn numbers of each segment, so a conversation of any length
comes out whole, and nearly every pair is a single row.

Turns agree if role and text agree, nulls included.  Rows that repeat a turn number make up that turn
together, stay in one part in the order of role and text, and agree if the same rows stand on both
sides.  A null turn number comes first.  A null role is rendered as ``unknown``, a null text as empty;
very long texts are rendered whole.  A side without partner has an empty prompt and is all completion.
Rows with a null conversation id belong to no pair and are left out.  An empty table gives no row.
Other columns of the input are not returned, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.skew import salted_join

PART_TURNS = 1024
TRAINED_ROLE = "assistant"
SIDES = ("chosen", "rejected")


def neighbours(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Adds ``pair_id`` and ``side``: conversation 2k is chosen over conversation 2k + 1."""
    number = F.col(id_col).cast("long")
    return conversations.filter(number.isNotNull()).withColumn("pair_id", F.shiftright(number, 1)).withColumn("side", F.when(number.bitwiseAND(F.lit(1)) == 0, "chosen").otherwise("rejected"))


def _header(role: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("unknown")), F.lit("|>\n"))


def first_difference(turns: DataFrame) -> DataFrame:
    """``(pair_id, fork, first)``: the least turn that differs, null if no turn does, and the least turn number."""
    mark = F.xxhash64(F.coalesce(F.concat(F.lit("="), "role"), F.lit("-")), F.coalesce(F.concat(F.lit("="), "text"), F.lit("-"))).cast("decimal(38,0)")
    side = lambda name, value: F.when(F.col("side") == name, value)
    met = turns.groupBy("pair_id", "turn", "turn_key").agg(
        *[F.count(side(s, F.lit(1))).alias(f"n_{s}") for s in SIDES], *[F.coalesce(F.sum(side(s, mark)), F.lit(0)).alias(f"sum_{s}") for s in SIDES]
    )
    differs = (F.col("n_chosen") != F.col("n_rejected")) | (F.col("sum_chosen") != F.col("sum_rejected"))
    return met.groupBy("pair_id").agg(F.min(F.when(differs, F.col("turn_key"))).alias("fork"), F.min("turn").alias("first"))


def format_pairs(turns: DataFrame, pair_col: str = "pair_id", side_col: str = "side", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", part_turns: int = PART_TURNS) -> DataFrame:
    """``pair_id, segment, part, turn, role, rendered, trained, mask_start, mask_end`` per rendered turn.

    ``segment`` is prompt, chosen or rejected; ``part`` counts its runs of ``part_turns`` turn numbers.  The
    mask is the span of ``rendered``, in code points, that counts towards the loss: the reply and its end
    mark, not the header.
    """
    least = F.lit(-(1 << 63)).cast("long")
    rows = turns.select(
        F.col(pair_col).alias("pair_id"), F.col(side_col).alias("side"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(turn_col).cast("long"), least).alias("turn_key"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    ).filter(F.col("side").isin(*SIDES))
    shared = F.col("fork").isNull() | (F.col("turn_key") < F.col("fork"))
    # One pair may hold a third of all turns.
    placed = salted_join(rows, first_difference(rows), ["pair_id"], F.xxhash64("turn")).withColumn("segment", F.when(shared, "prompt").otherwise(F.col("side")))
    placed = placed.filter((F.col("segment") != "prompt") | (F.col("side") == "chosen"))
    begins = F.when((F.col("segment") == "prompt") | (F.col("fork") == least), F.col("first")).otherwise(F.col("fork"))
    wide = lambda c: c.cast("decimal(20,0)")
    part = F.coalesce(F.floor((wide(F.col("turn")) - wide(begins)) / F.lit(part_turns)).cast("long"), F.lit(0).cast("long"))
    head = _header(F.col("role"))
    rendered = F.concat(head, F.coalesce("text", F.lit("")), F.lit("<|end|>\n"))
    trained = (F.col("segment") != "prompt") & F.coalesce(F.col("role") == TRAINED_ROLE, F.lit(False))
    return placed.select(
        "pair_id",
        "segment",
        part.alias("part"),
        "turn",
        "role",
        rendered.alias("rendered"),
        trained.alias("trained"),
        F.when(trained, F.char_length(head)).cast("long").alias("mask_start"),
        F.when(trained, F.char_length(rendered) - 1).cast("long").alias("mask_end"),
    )


def assemble(formatted: DataFrame) -> DataFrame:
    """``pair_id, part, prompt, chosen, rejected, chosen_mask, rejected_mask``, one row per pair and part.

    Masks are spans of the part's completion in code points.  The texts of a pair's parts, end to end, are
    its whole prompt and completions.
    """
    held = F.array_sort(F.collect_list(F.struct("turn", "role", "rendered", "trained", "mask_start", "mask_end")))
    sides = formatted.groupBy("pair_id", "part", "segment").agg(held.alias("t"))
    text = F.array_join(F.transform("t", lambda x: x.rendered), "")
    spans = F.expr(
        """aggregate(t, named_struct('at', 0L, 'spans', cast(array() as array<struct<start:bigint,end:bigint>>)),
             (acc, x) -> named_struct('at', acc.at + char_length(x.rendered),
               'spans', if(x.trained, concat(acc.spans, array(named_struct('start', acc.at + x.mask_start, 'end', acc.at + x.mask_end))), acc.spans)),
             acc -> acc.spans)"""
    )
    sides = sides.select("pair_id", "part", "segment", text.alias("text"), spans.alias("spans"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    part = lambda name, c: F.first(F.when(F.col("segment") == name, F.col(c)), ignorenulls=True)
    return sides.groupBy("pair_id", "part").agg(
        *[F.coalesce(part(s, "text"), F.lit("")).alias(s) for s in ("prompt", *SIDES)],
        *[F.coalesce(part(s, "spans"), none).alias(f"{s}_mask") for s in SIDES],
    )


def spell_masks(pairs: DataFrame) -> DataFrame:
    """``pairs`` with each mask as text, ``start-end`` joined by commas."""
    spelled = lambda c: F.array_join(F.transform(c, lambda m: F.concat_ws("-", m.start.cast("string"), m.end.cast("string"))), ",")
    return pairs.withColumns({f"{s}_mask": spelled(f"{s}_mask") for s in SIDES})


OP2_SQL = f"""
WITH t AS (
  SELECT CASE WHEN conv_id >= 0 THEN conv_id // 2 ELSE (conv_id - 1) // 2 END AS pair_id, conv_id % 2 = 0 AS is_chosen,
         CAST(turn AS BIGINT) AS turn, role, text, coalesce(turn, -9223372036854775808) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
side AS (
  SELECT pair_id, is_chosen, k, list_sort(list(coalesce('=' || role, '-') || chr(31) || coalesce('=' || text, '-'))) AS body
  FROM t GROUP BY ALL),
fork AS (
  SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, min(coalesce(a.k, b.k)) AS fork
  FROM (SELECT * FROM side WHERE is_chosen) a
  FULL JOIN (SELECT * FROM side WHERE NOT is_chosen) b ON a.pair_id = b.pair_id AND a.k = b.k
  WHERE a.body IS DISTINCT FROM b.body GROUP BY 1),
firsts AS (SELECT pair_id, min(turn) AS first FROM t GROUP BY 1),
placed AS (
  SELECT t.*, fork, first, CASE WHEN fork IS NULL OR k < fork THEN 'prompt' WHEN is_chosen THEN 'chosen' ELSE 'rejected' END AS segment
  FROM t LEFT JOIN fork USING (pair_id) JOIN firsts USING (pair_id)),
drawn AS (
  SELECT *, '<|' || coalesce(role, 'unknown') || '|>' || chr(10) AS head,
         segment <> 'prompt' AND coalesce(role = 'assistant', false) AS trained,
         coalesce((turn - CASE WHEN segment = 'prompt' OR fork = -9223372036854775808 THEN first ELSE fork END) // {PART_TURNS}, 0) AS part
  FROM placed WHERE segment <> 'prompt' OR is_chosen),
full_text AS (SELECT *, head || coalesce(text, '') || '<|end|>' || chr(10) AS rendered FROM drawn),
set_out AS (
  SELECT *, row_number() OVER w AS nth, coalesce(sum(length(rendered)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begun
  FROM full_text WINDOW w AS (PARTITION BY pair_id, segment, part ORDER BY turn NULLS FIRST, role NULLS FIRST, rendered)),
whole AS (
  SELECT pair_id, part, segment, string_agg(rendered, '' ORDER BY nth) AS text,
         string_agg(CAST(begun + length(head) AS BIGINT) || '-' || CAST(begun + length(rendered) - 1 AS BIGINT), ',' ORDER BY nth) FILTER (trained) AS mask
  FROM set_out GROUP BY ALL)
SELECT pair_id, part, coalesce(max(text) FILTER (segment = 'prompt'), '') AS prompt, coalesce(max(text) FILTER (segment = 'chosen'), '') AS chosen,
       coalesce(max(text) FILTER (segment = 'rejected'), '') AS rejected, coalesce(max(mask) FILTER (segment = 'chosen'), '') AS chosen_mask,
       coalesce(max(mask) FILTER (segment = 'rejected'), '') AS rejected_mask
FROM whole GROUP BY pair_id, part
"""
