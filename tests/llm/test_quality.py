import math
import random
import re
from collections import Counter

from lodestone.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup, lines = set(), 0, 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += 1
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), lines, dup, len(covered)


def rows():
    rng = random.Random(7)
    out = []
    for i in range(400):
        n = rng.randint(0, 150)
        words = [rng.choice(["alpha", "beta", "gamma", "δέλτα", "x"]) + str(rng.randint(0, 400)) for _ in range(n)]
        text = " ".join(words)
        if i % 9 == 0:
            text = " ".join(w + rng.choice(["###", "&&"]) for w in words)
        if i % 11 == 0:
            text = "\n".join(["the same line here"] * rng.randint(1, 30))
        if i % 13 == 0:
            text = " ".join((words * 3)[:120])
        out.append((i, text, rng.choice(["en", "fr", None]), rng.choice(["a", "a", "b", None])))
    out += [(900, None, "en", "a"), (901, "", None, None), (902, " \n x\n x\nx\n\n", "zz", "z"), (903, "a b a b a b", "en", "b"), (904, "w " * 3000, "en", "a"), (0, out[0][1], "en", "a")]
    return out


def brute_kept(data, reach=quality.REACH, prior=quality.PRIOR):
    def shares(m):
        n, chars, sym, lines, dup, rep = m
        w = max(n, 1)
        return {"mean_length": chars / w, "symbol_share": sym / w, "line_share": dup / max(lines, 1), "repeat_share": rep / w}

    def bucket(v):
        return None if v <= 0 else math.ceil(math.log(v) / math.log(quality.GAMMA) - 1e-9)

    def value(b):
        return 0.0 if b is None else 2 * quality.GAMMA**b / (quality.GAMMA + 1)

    measured = [(r, brute(r[1])) for r in data]
    groups = {}
    for (_, _, lang, source), m in measured:
        for key in ((lang, source), (lang,), ()):
            groups.setdefault(key, []).append(shares(m))

    def quantiles(key, k):
        held = sorted((bucket(s[k]) for s in groups[key]), key=lambda b: -math.inf if b is None else b)
        own = [value(next(b for i, b in enumerate(held, 1) if i >= q * len(held))) for q in (0.01, 0.05, 0.5, 0.95, 0.99)]
        if not key:
            return own
        return [(len(held) * x + prior * y) / (len(held) + prior) for x, y in zip(own, quantiles(key[:-1], k))]

    def fence(key, k):
        q01, q05, q50, q95, q99 = quantiles(key, k)
        low, high = (q05 if q05 < q50 else q01), (q95 if q95 > q50 else q99)
        return q50 - reach * (q50 - low), q50 + reach * (high - q50)

    out = Counter()
    for (i, _, lang, source), m in measured:
        failed = m[0] < 50 or 100 * m[5] > 50 * m[0]
        inside = all(lo - 1e-9 <= value(bucket(shares(m)[k])) <= hi + 1e-9 for k in quality.MEASURES for lo, hi in [fence((lang, source), k)])
        out[i, m[0], m[1], m[2], m[4], m[5], failed, not failed and inside] += 1
    return out


def test_counts_and_verdicts_match_brute_force(spark):
    data = rows()
    df = spark.createDataFrame([(*r, 1) for r in data], SCHEMA + ", n_words int")
    assert Counter(tuple(r) for r in quality.judge(df).collect()) == brute_kept(data)


def test_sketches_merge(spark):
    df = spark.createDataFrame(rows(), SCHEMA).selectExpr("*", "coalesce(lang, '-') as lang_key", "coalesce(source, '-') as source_key")
    measured = quality.measure(df, "text", ("lang_key", "source_key"))
    parts = quality.merge(quality.sketch(measured, ["lang_key", "source_key"]), ["lang_key"])
    whole = quality.sketch(measured, ["lang_key"])
    assert Counter(tuple(r) for r in parts.select(*whole.columns).collect()) == Counter(tuple(r) for r in whole.collect())


def test_empty_and_filter(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    assert quality.judge(df.limit(0)).collect() == []
    kept = quality.keep(df)
    assert kept.columns == df.columns and 0 < kept.count() < df.count()


def test_fences_adapt_to_their_group(spark):
    """What is usual in one group is an outlier in another, however many documents share it."""
    rng = random.Random(5)
    text = lambda mark, n: " ".join(f"{rng.choice('abcdefgh')}{rng.randint(100, 999)}" + (mark if i < n else "") for i in range(100))
    data = [(i, text("#", rng.randint(40, 60)), "en", "code") for i in range(400)] + [(1000 + i, text("", 0), "en", "news") for i in range(400)]
    data += [(2000 + i, text("#", 50), "en", "news") for i in range(3)]
    kept = {r.id: r.kept for r in quality.judge(spark.createDataFrame(data, SCHEMA)).collect()}
    assert sum(kept[i] for i in range(400)) >= 390 and sum(kept[1000 + i] for i in range(400)) >= 390
    assert not any(kept[2000 + i] for i in range(3))


def test_rows_are_kept_one_by_one(spark):
    rng = random.Random(6)
    text = lambda: " ".join(f"w{rng.randint(0, 999)}" for _ in range(80))
    data = [(i % 3 if i % 2 else None, text() if i % 5 else "short", "en", "a") for i in range(200)]
    df = spark.createDataFrame([(*r, "x", 1) for r in data], SCHEMA + ", kept string, lang_key int")
    out = quality.keep(df)
    assert out.columns == df.columns
    texts = Counter(r.text for r in out.collect())
    assert "short" not in texts and sum(texts.values()) >= 150
