"""Quality rules with adaptive thresholds, in DataFrame operations only.

Every text is measured; each measure is summarised per language and source in a mergeable quantile
sketch, and the fences drawn from the sketches replace fixed cutoffs: a document is kept if none of its
measures lies more than ``reach`` times as far from its group's median as the 5th or 95th percentile
does.  Where that percentile equals the median, as for measures that are mostly zero, the 1st or 99th
takes its place; of a measure that is constant beyond that, any other value is an outlier of at most one
row in a hundred.

The sketch counts values in logarithmic buckets (relative error ``(gamma - 1) / (gamma + 1)``), so
merging is adding counts: the result does not depend on the order of rows, and partial sketches are
built before any shuffle.  Quantiles of a group are drawn towards those of its language, and these
towards those of all rows, with the weight of ``prior`` rows; the rule is the same for groups of any size.

Null texts have no words and fail the base rules.  Null languages and sources are groups of their own.
Rows that repeat are measured and counted like any other.  Very long texts are measured whole, in memory
of the order of the text.  An empty table gives no row.  Other columns are not read by ``judge`` and all
kept by ``keep``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.skew import FILE, ROW, placed, salted_join
from lodestone.llm.words import words
from lodestone.session import materialize

GAMMA = 1.02
REACH = 2.0
#: Rows' weight of the language's quantiles in those of its groups.
PRIOR = 50
MEASURES = ("mean_length", "symbol_share", "line_share", "repeat_share")
QUANTILES = {"q01": 0.01, "q05": 0.05, "q50": 0.5, "q95": 0.95, "q99": 0.99}
MIN_WORDS = 50
_SYMBOLS = r"[#*$%&|<>]+"
_BLANK = r"\x20\x09-\x0D"


def _repeat_words(n: Column) -> Column:
    """Words inside 3-word windows that occur at least twice, from the window hashes ``grams``.

    Windows are sorted as one long each, the leading bits of the hash over the position, so equal
    windows become neighbours; whole hashes are compared before a window counts as repeated.
    """
    return F.expr(
        """aggregate(
            sort_array(flatten(transform(array(sort_array(transform(grams, (h, i) -> (h & shiftleft(-1L, bits)) | i))), s ->
                transform(
                    filter(s, (x, i) -> coalesce(get(grams, int(x & ~shiftleft(-1L, bits))) = get(grams, int(get(s, i - 1) & ~shiftleft(-1L, bits))), false)
                                     or coalesce(get(grams, int(x & ~shiftleft(-1L, bits))) = get(grams, int(get(s, i + 1) & ~shiftleft(-1L, bits))), false)),
                    x -> x & ~shiftleft(-1L, bits))))),
            named_struct('n', 0L, 'next', 0L),
            (acc, p) -> named_struct('n', acc.n + 3 - greatest(0L, acc.next - p), 'next', p + 3),
            acc -> acc.n)"""
    )


def measure(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Base counts of every whole text, beside the columns ``keep``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    w = docs.select(*[F.col(c).alias(f"key_{c}") for c in keep], text.alias("body"), words(text).alias("w"))
    lines = F.filter(F.split("body", "\n"), lambda x: x.rlike(f"[^{_BLANK}]"))
    first = w.select(
        *[f"key_{c}" for c in keep],
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.char_length("body") - F.char_length(F.regexp_replace("body", _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.expr("if(size(w) < 3, array(), transform(sequence(0, greatest(size(w) - 3, 0)), i -> xxhash64(get(w, i), get(w, i + 1), get(w, i + 2))))").cast("array<bigint>").alias("grams"),
    )
    second = first.withColumn("bits", F.ceil(F.log2(F.greatest(F.col("n_words"), F.lit(2)) + 1)).cast("int")).withColumn("unlike", F.size(F.array_distinct("grams")))
    return second.select(
        *[F.col(f"key_{c}").alias(c) for c in keep],
        "n_words",
        "word_chars",
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("unlike") == F.size("grams"), F.lit(0)).otherwise(_repeat_words(F.col("n_words"))).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def shares() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "mean_length": F.col("word_chars") / n,
        "symbol_share": F.col("n_symbols") / n,
        "line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / n,
    }


def bucket_of(value: Column, gamma: float = GAMMA) -> Column:
    """Logarithmic bucket of a value; null for zero, which is counted apart."""
    return F.when(value > 0, F.ceil(F.log(value) / F.log(F.lit(gamma)) - 1e-9)).cast("int")


def value_of(bucket: Column, gamma: float = GAMMA) -> Column:
    return F.coalesce(2 * F.pow(F.lit(gamma), bucket) / (gamma + 1), F.lit(0.0))


def sketch(measured: DataFrame, groups: list[str]) -> DataFrame:
    """``(groups, measure, bucket, n)``: one quantile sketch per group and measure."""
    each = F.array(*[F.struct(F.lit(k).alias("measure"), bucket_of(v).alias("bucket")) for k, v in shares().items()])
    return measured.select(*groups, F.explode(each).alias("x")).groupBy(*groups, "x.measure", "x.bucket").agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, groups: list[str]) -> DataFrame:
    return sketches.groupBy(*groups, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """``(groups, measure, total, q01, q05, q50, q95, q99)`` out of sketches."""
    by = Window.partitionBy(*groups, "measure")
    run = by.orderBy(F.col("bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = sketches.withColumn("upto", F.sum("n").over(run)).withColumn("total", F.sum("n").over(by))
    value = value_of(F.col("bucket"))
    return counted.groupBy(*groups, "measure").agg(
        F.max("total").alias("total"),
        *[F.min(F.when(F.col("upto") >= F.lit(q) * F.col("total"), value)).alias(name) for name, q in QUANTILES.items()],
    )


def _towards(own: str, other: str, prior: int) -> list[Column]:
    """The quantiles of ``own`` drawn towards those of ``other``."""
    n = F.col(f"{own}.total")
    return [((n * F.col(f"{own}.{q}") + F.lit(prior) * F.col(f"{other}.{q}")) / (n + prior)).alias(q) for q in QUANTILES]


def fences(sketches: DataFrame, lang: str = "lang_key", source: str = "source_key", reach: float = REACH, prior: int = PRIOR) -> DataFrame:
    """``(lang, source, low_<measure>, high_<measure>)`` of every group."""
    packed = lambda df, keys, name: df.select(*keys, "measure", F.struct("total", *QUANTILES).alias(name))
    own = packed(quantiles(sketches, [lang, source]), [lang, source], "own")
    tongue = packed(quantiles(merge(sketches, [lang]), [lang]), [lang], "raw")
    everything = packed(quantiles(merge(sketches, []), []), [], "everything")
    tongue = tongue.join(everything, "measure").select(lang, "measure", F.struct(*_towards("raw", "everything", prior)).alias("tongue"))
    drawn = own.join(tongue, [lang, "measure"]).select(lang, source, "measure", *_towards("own", "tongue", prior))
    low = F.when(F.col("q05") < F.col("q50"), F.col("q05")).otherwise(F.col("q01"))
    high = F.when(F.col("q95") > F.col("q50"), F.col("q95")).otherwise(F.col("q99"))
    middle = F.col("q50")
    ranged = drawn.select(lang, source, "measure", (middle - reach * (middle - low)).alias("low"), (middle + reach * (high - middle)).alias("high"))
    return ranged.groupBy(lang, source).agg(*[F.max(F.when(F.col("measure") == k, F.col(side))).alias(f"{side}_{k}") for k in MEASURES for side in ("low", "high")])


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", reach: float = REACH, prior: int = PRIOR, salts: int = 32, keys: tuple[str, ...] = ()) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` of every document, beside its id and the columns ``keys``."""
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    keyed = docs.select(F.col(id_col).alias("id"), key(lang_col).alias("lang_key"), key(source_col).alias("source_key"), F.col(text_col).alias("text"), *keys)
    measured = materialize(measure(keyed, "text", ("id", "lang_key", "source_key", *keys)), "quality-measures")
    limits = fences(sketch(measured, ["lang_key", "source_key"]), reach=reach, prior=prior)
    inside = F.lit(True)
    for k, v in shares().items():
        # Fences are made of bucket values, so a share counts as that of its bucket.
        v = value_of(bucket_of(v))
        inside = inside & (v <= F.col(f"high_{k}") + 1e-9) & (v >= F.col(f"low_{k}") - 1e-9)
    # A third of all rows may share a language and source: rows are salted, the few fences repeated.
    joined = salted_join(measured, limits, ["lang_key", "source_key"], F.xxhash64("id", "n_words", "word_chars"), salts=salts)
    return joined.select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), (~base_failed() & inside).alias("kept"), *keys)


def keep(docs: DataFrame, id_col: str = "doc_id", **rules) -> DataFrame:
    """The rows of ``docs`` that are kept, each judged by itself whether or not its id repeats."""
    rows = placed(docs, "quality-docs")
    kept = judge(rows, id_col, keys=(FILE, ROW), **rules).filter("kept").select(FILE, ROW)
    return rows.join(kept.hint("shuffle_hash"), [FILE, ROW], "left_semi").select(*docs.columns)


def _level_sql(name: str, keys: str, i: int) -> str:
    drawn = ", ".join(f"min(val) FILTER (r{i} >= CAST({q} AS DOUBLE) * c{i}) AS {k}" for k, q in QUANTILES.items())
    group = f"measure{', ' + keys if keys else ''}"
    return f"{name} AS (SELECT {group}, max(c{i}) AS total, {drawn} FROM ranked GROUP BY {group})"


def _towards_sql(own: str, other: str) -> str:
    return ", ".join(f"({own}.total * {own}.{q} + {PRIOR} * {other}.{q}) / ({own}.total + {PRIOR}) AS {q}" for q in QUANTILES)


OP10_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce('=' || lang, '-') AS lk, coalesce('=' || source, '-') AS sk FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln FROM d),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
dup AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM dup, (SELECT unnest([0, 1, 2]) AS k) GROUP BY 1),
m AS (SELECT doc_id, lk, sk, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ln) AS BIGINT) AS n_lines,
             CAST(len(ln) - len(list_distinct(ln)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN cov USING (doc_id)),
s AS (SELECT doc_id, lk, sk, unnest(['mean_length', 'symbol_share', 'line_share', 'repeat_share']) AS measure,
             unnest([word_chars / greatest(n_words, 1), n_symbols / greatest(n_words, 1), n_dup_lines / greatest(n_lines, 1), n_repeat_words / greatest(n_words, 1)]) AS v FROM m),
b AS (SELECT *, CASE WHEN v > 0 THEN CAST(ceil(ln(v) / ln({GAMMA}) - 1e-9) AS INT) END AS bucket FROM s),
ranked AS (SELECT *, coalesce(2 * pow({GAMMA}, bucket) / ({GAMMA} + 1), 0.0) AS val,
             row_number() OVER (PARTITION BY measure, lk, sk ORDER BY bucket NULLS FIRST) AS r1, count(*) OVER (PARTITION BY measure, lk, sk) AS c1,
             row_number() OVER (PARTITION BY measure, lk ORDER BY bucket NULLS FIRST) AS r2, count(*) OVER (PARTITION BY measure, lk) AS c2,
             row_number() OVER (PARTITION BY measure ORDER BY bucket NULLS FIRST) AS r3, count(*) OVER (PARTITION BY measure) AS c3 FROM b),
{_level_sql('own', 'lk, sk', 1)}, {_level_sql('raw', 'lk', 2)}, {_level_sql('everything', '', 3)},
tongue AS (SELECT raw.measure, raw.lk, {_towards_sql('raw', 'everything')} FROM raw JOIN everything USING (measure)),
p AS (SELECT own.measure, own.lk, own.sk, {_towards_sql('own', 'tongue')} FROM own JOIN tongue USING (measure, lk)),
f AS (SELECT measure, lk, sk, q50 - {REACH} * (q50 - CASE WHEN q05 < q50 THEN q05 ELSE q01 END) AS low,
             q50 + {REACH} * (CASE WHEN q95 > q50 THEN q95 ELSE q99 END - q50) AS high FROM p),
inside AS (SELECT doc_id, bool_and(val <= high + 1e-9 AND val >= low - 1e-9) AS ok FROM ranked JOIN f USING (measure, lk, sk) GROUP BY doc_id),
judged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND ok AS kept FROM judged JOIN inside USING (doc_id)
"""
