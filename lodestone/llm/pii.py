"""Personal data: base patterns plus bootstrapped contextual extraction.

Base matches (e-mail, IPv4 address, payment card, phone) and long credential-like strings are the seed
entities.  Every seed and every identifier-like run is an instance; the tokens around it are its
lexical patterns.  Spark then scores the bipartite graph of patterns and instances until the set of
sure patterns no longer changes: a pattern is as sure as the share of its distinct instances that are
known, an instance as sure as the noisy-or of its patterns.  Patterns that reach ``min_confidence``
with ``min_support`` known instances mark the unseen identifiers in their slot.  A credential-like
string is only a seed: it is marked as ``secret`` where a sure pattern holds it, and never by its shape
alone.  Added spans never overlap base spans.

Null and empty texts have no spans.  Spans are determined by the text alone, so copies and repeated
rows agree, and the graph counts distinct instances, so a large group of copies cannot outvote the rest.
Scores are whole millionths, so no sum depends on the order of rows; of two kinds that are equally sure
the one that is listed first wins.  Whole texts are read in time linear in their length; a pattern sees
64 characters on either side of its slot.  An empty table gives an empty result.  Offsets are code points
with an exclusive end.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.llm.batches import with_columns
from lodestone.llm.skew import salted_join
from lodestone.session import materialize

KINDS = ("email", "ip", "card", "phone")
SECRET = len(KINDS)
ALL_KINDS = (*KINDS, "secret")
SURE = 1_000_000
#: Most digits of one identifier; longer runs of numbers are taken word by word.
MOST_DIGITS = 24
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_CANDIDATE = re.compile(r"(?<!\S)(?:[^\s0-9@]*+)[0-9@]\S*+")
_NUMBER = re.compile(r"[0-9().+/-]+")
_SHAPE = re.compile(r"[0-9A-Za-z+/_=-]{32,}")
_TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")
_DOUBLED = str.maketrans("0123456789", "0246813579")


def _luhn(digits: str) -> bool:
    return (sum(map(int, digits[-1::-2])) + sum(map(int, digits[-2::-2].translate(_DOUBLED)))) % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """``(start, kind index, end)`` in order; linear in the text."""
    if not text:
        return []
    out = []
    at = 0
    while (p := text.find("@", at)) >= 0:
        left = text[at:p]
        local = len(left) - len(left.rstrip(_LOCAL))
        hit = _DOMAIN.match(text, p + 1) if local else None
        at = p + 1
        if hit:
            out.append((p - local, 0, hit.end()))
            at = hit.end()
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(x := g.lstrip("0")) < 4 and int(x or 0) <= 255 for g in m.groups()):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_digits(m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _context(text: str, start: int, end: int, reach: int = 64) -> list[str]:
    """Lexical patterns of the slot ``text[start:end]``: three tokens before it, and two before with one after it."""
    left = [_DIGIT.sub("0", w) for w in _TOKEN.findall(text[max(0, start - reach) : start].lower())[-3:]]
    right = [_DIGIT.sub("0", w) for w in _TOKEN.findall(text[end : end + reach].lower())[:1]]
    if start <= reach and len(left) < 3:
        left = ["^", *left]
    if len(left) < 2:
        return []
    return [" ".join([*left, "_"]), " ".join([*left[-2:], "_", *(right or ["$"])])]


def _runs(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Identifier-like runs outside the base spans: words with a digit or an at sign, numbers joined over single blanks."""
    edges = sorted((a, b) for a, _, b in spans)
    out: list[list[tuple[int, int]]] = []
    at, joins, last = 0, False, -1
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        while a < b and not (text[a].isalnum() or text[a] in "+("):
            a += 1
        while b > a and not text[b - 1].isalnum():
            b -= 1
        while at < len(edges) and edges[at][1] <= a:
            at += 1
        if a == b or (at < len(edges) and edges[at][0] < b):
            joins = False
            continue
        number = _NUMBER.fullmatch(text, m.start(), m.end()) is not None
        if joins and number and m.start() == last + 1 and text[last] == " ":
            out[-1].append((a, b))
        else:
            out.append([(a, b)])
        joins, last = number, m.end()
    split = []
    for run in out:
        whole = sum(len(_DIGIT.findall(text, a, b)) for a, b in run) <= MOST_DIGITS
        split += [(run[0][0], run[-1][1])] if whole else run
    return split


def _worth(word: str) -> bool:
    digits = len(_DIGIT.findall(word))
    return digits >= 4 or "@" in word or (digits > 0 and len(word) >= 8)


def _is_secret(word: str) -> bool:
    digits = len(_DIGIT.findall(word))
    return _SHAPE.fullmatch(word) is not None and digits >= 6 and sum(map(str.isalpha, word)) >= 6


def mentions_of(text: str | None, spans: list[tuple[int, int, int]]) -> list[tuple[int | None, int | None, int, int, int, list[int]]]:
    """``(kind or None, seed kind or None, start, end, instance, patterns)``: base spans, then other identifier-like runs."""
    import xxhash

    if not text or not re.search("[0-9@]", text):
        return []

    def key(x: str) -> int:
        h = xxhash.xxh64_intdigest(x.encode())
        return h - (1 << 64) if h >> 63 else h

    out = [(k, k, a, b, key(text[a:b].lower()), [key(c) for c in _context(text, a, b)]) for a, k, b in spans]
    for a, b in _runs(text, spans):
        word = text[a:b]
        if _worth(word) and (found := _context(text, a, b)):
            out.append((None, SECRET if _is_secret(word) else None, a, b, key(word.lower()), [key(c) for c in found]))
    return out


def spell(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{ALL_KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


_MENTION = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.IntegerType()),
            T.StructField("seed", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("instance", T.LongType()),
            T.StructField("patterns", T.ArrayType(T.LongType())),
        ]
    )
)
_KEY, _MENTIONS, _ADDED = "__pii_key", "__pii_mentions", "__pii_added"
_SCANNED = T.StructType(
    [
        *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS),
        T.StructField("base_sha256", T.StringType()),
        T.StructField("base", T.StringType()),
        T.StructField(_KEY, T.StringType()),
        T.StructField(_MENTIONS, _MENTION),
    ]
)


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with base counts, base spans, a text key and all mentions."""
    names = [f.name for f in _MENTION.elementType]

    def start():
        def compute(texts):
            cols = [[] for _ in _SCANNED]
            for text in texts.to_pylist():
                spans = base_spans(text)
                base = spell(spans)
                mentions = mentions_of(text, spans)
                row = [*(sum(k == i for _, k, _ in spans) for i in range(len(KINDS)))]
                row += [hashlib.sha256(base.encode()).hexdigest(), base]
                row += [hashlib.sha256(text.encode()).hexdigest() if any(m[0] is None for m in mentions) else None]
                row += [[dict(zip(names, m)) for m in mentions]]
                for col, x in zip(cols, row):
                    col.append(x)
            return cols

        return compute

    return with_columns(docs, [text_col], _SCANNED, start, (text_col,))


def learn_patterns(scanned: DataFrame, min_support: int = 5, min_confidence: float = 0.8, accept: float = 0.8, most_rounds: int = 50) -> DataFrame:
    """``(pattern, kind, confidence)`` of the sure patterns, confidence in millionths.

    ``confidence`` is the score sum of a pattern's distinct instances over their number; an instance
    that is not a seed counts only once its noisy-or reaches ``accept``.  Known instances only ever grow
    in number, so the rounds end; graphs that need more than ``most_rounds`` keep what they have by then.
    """
    each = scanned.select(F.explode(_MENTIONS).alias("m")).select("m.seed", "m.instance", F.explode("m.patterns").alias("pattern"))
    edges = materialize(each.groupBy("instance", "pattern").agg(F.max("seed").alias("kind")), "pii-graph")
    pairs = edges.select("instance", "pattern")
    size = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    seeds = edges.filter("kind is not null").select("instance", "kind", F.lit(SURE).cast("long").alias("score")).distinct()
    known, seen, sure = seeds, None, None
    for _ in range(most_rounds):
        # A number may stand in a million contexts, a context may hold a million numbers: both joins are salted.
        held = salted_join(pairs, known, ["instance"], F.xxhash64("pattern")).groupBy("pattern", "kind").agg(F.sum("score").alias("mass"), F.count("*").alias("support"))
        rated = held.join(size, "pattern").withColumn("confidence", F.expr("mass div n"))
        sure = materialize(rated.filter((F.col("support") >= min_support) & (F.col("confidence") >= int(min_confidence * SURE))).select("pattern", "kind", "confidence"), "pii-patterns")
        mark = sure.agg(F.count("*").alias("n"), F.sum("confidence").alias("c")).first()
        if not mark.n or tuple(mark) == seen:
            break
        seen = tuple(mark)
        doubt = F.round(F.log1p(-F.least(F.col("confidence") / SURE, F.lit(0.99))) * SURE).cast("long")
        found = salted_join(pairs, sure, ["pattern"], F.xxhash64("instance")).groupBy("instance", "kind").agg(F.sum(doubt).alias("doubt"))
        found = found.withColumn("score", F.round((1 - F.exp(F.col("doubt") / SURE)) * SURE).cast("long")).filter(F.col("score") >= int(accept * SURE))
        known = seeds.unionByName(found.join(seeds.select("instance"), "instance", "left_anti").select("instance", "kind", "score"))
    return sure


def added_spans(scanned: DataFrame, patterns: DataFrame) -> DataFrame:
    """Spans that the patterns find in each distinct text that has any, by text key."""
    slots = (
        scanned.filter(F.col(_KEY).isNotNull())
        .select(_KEY, F.explode(F.filter(_MENTIONS, lambda m: m.kind.isNull())).alias("m"))
        .select(_KEY, "m.start", "m.end", F.explode("m.patterns").alias("pattern"))
        .distinct()
    )
    hits = salted_join(slots, patterns, ["pattern"], F.xxhash64(_KEY, "start")).groupBy(_KEY, "start", "end").agg(F.max_by("kind", F.struct("confidence", -F.col("kind"))).alias("kind"))
    return hits.groupBy(_KEY).agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias(_ADDED))


def _with_added(docs: DataFrame, added: DataFrame) -> DataFrame:
    """``docs`` with the spans added to their text.

    Rows without a key have no candidate and are left out of the join, where their nulls would all meet in
    one task; copies of one text are dealt by the task that scans them.
    """
    joined = salted_join(docs.filter(F.col(_KEY).isNotNull()), added, [_KEY], F.spark_partition_id(), "left")
    return joined.unionByName(docs.filter(F.col(_KEY).isNull()).withColumn(_ADDED, F.lit(None).cast(added.schema[_ADDED].dataType)))


def find(docs: DataFrame, text_col: str = "text", **learning) -> DataFrame:
    """``docs`` without the text, with ``n_<kind>`` of the base kinds, ``base``, ``base_sha256`` and ``spans``.

    Columns of ``docs`` with one of these names give way; all others stay.
    """
    scanned = materialize(scan(docs.drop("spans") if text_col != "spans" else docs, text_col), "pii-scan")
    added = added_spans(scanned, learn_patterns(scanned, **learning))
    merged = F.array_sort(
        F.concat(
            F.transform(F.filter(_MENTIONS, lambda m: m.kind.isNotNull()), lambda m: F.struct(m.start.alias("start"), m.kind.alias("kind"), m.end.alias("end"))),
            F.coalesce(_ADDED, F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")),
        )
    )
    names = F.array(*map(F.lit, ALL_KINDS))
    text = F.transform(merged, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string")))
    return _with_added(scanned, added).withColumn("spans", F.array_join(text, ",")).drop(_MENTIONS, _ADDED, _KEY)


def _fill(text: str, spans: list[tuple[int, int, int]]) -> str:
    parts, at = [], 0
    for a, k, b in sorted(spans):
        if b > at:
            parts += [text[at : max(a, at)], f"<{ALL_KINDS[k].upper()}>" if a >= at else ""]
            at = b
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", most_patterns: int = 200_000, **learning) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; all other columns stay.

    Up to ``most_patterns`` sure patterns (some 5 MB) travel to the tasks, so no text is shuffled; more of
    them stay in their table, and texts meet their spans in a join with the same result.
    """
    scanned = materialize(scan(docs.select(text_col), text_col).select(_KEY, _MENTIONS).filter(F.size(_MENTIONS) > 0), "pii-scan")
    sure = learn_patterns(scanned, **learning)
    fields = T.StructType([T.StructField(text_col, T.StringType())])
    rows = sure.limit(most_patterns + 1).collect()
    if len(rows) <= most_patterns:
        ranked: dict[int, tuple[int, int]] = {}
        for r in rows:
            ranked[r.pattern] = max(ranked.get(r.pattern, (0, 0)), (r.confidence, -r.kind))
        held = docs.sparkSession.sparkContext.broadcast(ranked)

        def start():
            best = held.value

            def one(text):
                spans = base_spans(text)
                for kind, _, a, b, _, patterns in mentions_of(text, spans) if best and text else ():
                    if kind is None and (hits := [best[p] for p in patterns if p in best]):
                        spans = [*spans, (a, -max(hits)[1], b)]
                return _fill(text, spans) if spans else text

            return lambda texts: [[one(t) for t in texts.to_pylist()]]

        return with_columns(docs, [text_col], fields, start).select(*docs.columns)

    joined = _with_added(docs.withColumn(_KEY, F.sha2(F.col(text_col).cast("binary"), 256)), added_spans(scanned, sure)).drop(_KEY)

    def start_joined():
        def compute(texts, found):
            out = []
            for text, more in zip(texts.to_pylist(), found.to_pylist()):
                spans = base_spans(text) + [(s["start"], s["kind"], s["end"]) for s in more or ()]
                out.append(_fill(text, spans) if spans else text)
            return [out]

        return compute

    return with_columns(joined, [text_col, _ADDED], fields, start_joined).select(*docs.columns)
