import hashlib
import random
import re

from lodestone.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def brute(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def random_text(rng):
    parts = ["a", "Z", "9", "1.2.3.4", "256.1.1.1", "001.002.3.4", "@", ".", "b.com", "-", " ", "+1 (555) 555-1234", "4111 1111 1111 1111", "é", "😀", "\n", "+", "x@y.z%q@w.v", "(", "0"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))


def test_base_spans_match_brute_force():
    rng = random.Random(2)
    for text in [None, "", *(random_text(rng) for _ in range(5000))]:
        assert pii.base_spans(text) == brute(text)


def test_long_texts_stay_linear():
    for unit in ("9", "a", "1.", "@", "+1(", "a@", "9 ", "9-"):
        pii.base_spans(unit * 60_000)
        pii.mentions_of(unit * 60_000, [])


def documents(spark):
    rows = []
    for i in range(30):
        rows.append((i, f"write to my phone number {'+1 (%03d) 555-%04d' % (200 + i, 1000 + i)} after noon " + "x" * i))
    rows += [(100, "and my phone number 555 867 5309 works"), (101, "my phone number 5558675309 works"), (102, "the code 5558675309 works"), (103, None), (104, ""), (104, "")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_patterns_find_unseen_identifiers(spark):
    docs = documents(spark)
    out = {r.doc_id: r for r in pii.find(docs).collect()}
    for d in docs.collect():
        want = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in brute(d.text))
        assert out[d.doc_id].base == want
        assert out[d.doc_id].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert out[100].spans == "phone:20:32"  # one run of numbers, over its blanks
    assert out[101].spans == "phone:16:26"
    assert out[102].spans == ""  # known by now, but not in the slot of a sure pattern
    assert out[103].spans == out[104].spans == ""
    assert pii.find(docs).count() == docs.count()


def test_redaction_keeps_rows_and_columns(spark):
    docs = documents(spark).selectExpr("doc_id", "text", "1 as mentions", "'s' as spans")
    out = pii.redact(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[0] == "write to my phone number <PHONE> after noon "
    assert got[101] == "my phone number <PHONE> works"
    assert got[103] is None and got[104] == ""


def by_hand(texts, min_support=5, min_confidence=0.8, accept=0.8):
    """Added spans of each text, with dictionaries, fractions and no shared code but the mentions of a text."""
    from fractions import Fraction
    from math import prod

    mentions = {t: pii.mentions_of(t, pii.base_spans(t)) for t in set(texts) if t}
    holds, seeds = {}, {}
    for t in mentions:
        for _, seed, _, _, instance, patterns in mentions[t]:
            for p in patterns:
                holds.setdefault(p, set()).add(instance)
                if seed is not None:
                    seeds.setdefault((instance, p), set()).add(seed)
    known = {(i, max(k)): Fraction(1) for (i, _), k in seeds.items()}
    fixed = {i for i, _ in known}
    sure = {}
    while True:
        now = {}
        for p, inside in holds.items():
            for kind in range(5):
                scores = [known[i, kind] for i in inside if (i, kind) in known]
                if len(scores) >= min_support and sum(scores) / len(inside) >= min_confidence:
                    now[p, kind] = sum(scores) / len(inside)
        if now == sure:
            break
        sure = now
        found = {}
        for (p, kind), c in sure.items():
            for i in holds[p] - fixed:
                found.setdefault((i, kind), []).append(min(c, Fraction(99, 100)))
        known = {k: v for k, v in known.items() if k[0] in fixed}
        known |= {k: s for k, cs in found.items() if (s := 1 - prod(1 - c for c in cs)) >= accept}
    out = {}
    for t, ms in mentions.items():
        out[t] = []
        for kind, _, a, b, _, patterns in ms:
            hits = [(c, -k) for (p, k), c in sure.items() if p in patterns]
            if kind is None and hits:
                out[t].append((a, -max(hits)[1], b))
    return out


def corpus(rng, n=400):
    """Texts whose contexts hold a kind always, often, rarely or never."""
    slots = {"call desk line": 0.95, "fax the office": 0.85, "order was number": 0.3, "in the year": 0.0, 'the token = "': 1.0, "mail to us": 0.9}
    texts = []
    for _ in range(n):
        name = rng.choice(list(slots))
        good = rng.random() < slots[name]
        if "token" in name:
            value = "".join(rng.choice("0123456789abcdef") for _ in range(40)) if rng.random() < 0.9 else f"short{rng.randint(0, 9)}key"
            texts.append(f"{name}{value}\" end")
        elif "mail" in name:
            texts.append(f"{name} {'a%d@b.com' % rng.randint(0, 60) if good else 'a%d@intern' % rng.randint(0, 9)} soon")
        else:
            texts.append(f"x {name} {'+1 (%03d) 555-%04d' % (rng.randint(200, 230), rng.randint(1000, 1009)) if good else '030 %02d %02d %02d' % tuple(rng.randint(10, 30) for _ in range(3))} end")
    return texts


def test_pattern_graph_matches_brute_force(spark):
    rng = random.Random(8)
    texts = corpus(rng)
    texts += texts[:40] + [None, "", "no identifier"]
    want = by_hand(texts)
    added = sorted({k for spans in want.values() for _, k, _ in spans})
    assert added == [0, 3, 4]  # e-mails, phones and secrets that no base pattern finds
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for r in pii.find(df).collect():
        assert r.spans == pii.spell(pii.base_spans(texts[r.doc_id]) + want.get(texts[r.doc_id], []))


def test_redaction_joins_where_patterns_are_many(spark):
    texts = corpus(random.Random(9), 250) + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    few, many = pii.redact(df).collect(), pii.redact(df, most_patterns=0).collect()
    assert sorted(few, key=str) == sorted(many, key=str)
    assert sum("<SECRET>" in (r.text or "") for r in few) > 20


def test_planted_identifiers_precision_and_recall(spark):
    """Unseen identifiers planted into known contexts are found, decoys in other contexts are left alone."""
    rng = random.Random(10)
    word = lambda: "".join(rng.choice("aeioubcdr") for _ in range(rng.randint(2, 7)))
    filler = lambda: " ".join(word() for _ in range(rng.randint(5, 40)))
    texts, planted, decoys = [], set(), set()
    for i in range(600):
        lead, seed, unseen = rng.choice(
            [
                ("reach me at phone", "+1 (%03d) 555-%04d" % (rng.randint(200, 999), rng.randint(0, 9999)), "%03d %03d %04d" % (rng.randint(200, 999), rng.randint(200, 999), rng.randint(0, 9999))),
                ('set api token = "', "".join(rng.choice("0123456789abcdef") for _ in range(40)) + '"', "k%08d" % rng.randint(0, 10**8) + '"'),
                ("logged in from host", ".".join(str(rng.randint(1, 255)) for _ in range(4)), "fe80::%04d:%04d" % (rng.randint(1000, 9999), rng.randint(1000, 9999))),
            ]
        )
        is_new = i % 8 == 0
        texts.append(f"{filler()} {lead} {unseen if is_new else seed} {filler()}")
        if is_new:
            planted.add(i)
        if i % 5 == 0:
            texts[-1] += f" {word()} {word()} {word()} {rng.randint(10**6, 10**9)} {filler()}"
            decoys.add(i)
    out = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    hit = {r.doc_id for r in out if r.spans != r.base}
    assert len(hit & planted) / len(planted) >= 0.95
    marked = [(r.doc_id, int(s.split(":")[1])) for r in out for s in r.spans.split(",") if s]
    tail = {i: max(m.start() for m in re.finditer(r"[0-9]{6,10}", texts[i])) for i in decoys if i not in planted}
    assert not {(i, at) for i, at in tail.items()} & set(marked)


def test_clashing_columns(spark):
    names = ["added", "mentions", "text_key", "kind", "pattern", "instance", "start"]
    df = documents(spark).selectExpr("doc_id", "text", *[f"'{c}' as {c}" for c in names], "'old' as base", "'old' as spans", "7L as n_ip")
    out = pii.find(df)
    assert out.columns == ["doc_id", *names, "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "spans"]
    rows = out.collect()
    assert len(rows) == df.count() and all(r[c] == c for r in rows for c in names)
    assert {r.n_ip for r in rows} == {0} and "old" not in {r.spans for r in rows}
    assert sorted(r.doc_id for r in pii.redact(df).collect()) == sorted(r.doc_id for r in df.collect())


def test_empty_table(spark):
    assert pii.find(documents(spark).limit(0)).collect() == []
    assert pii.redact(documents(spark).limit(0)).collect() == []
