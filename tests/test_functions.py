import difflib
import hashlib
import json

from pyspark.sql import functions as F

from lodestone.functions import hashing, relations, text


def one(spark, schema, rows, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_normalizers(spark):
    rows = [("  Type-II  Diabetes ",), ("Kidney-disease_diabetic",), ("Straße, Ünï!",), ("",), (None,)]
    got = one(spark, "v string", rows, text.alias_key(F.col("v")), text.keyword_text(F.col("v")), text.search_text(F.col("v")), text.filter_text(F.col("v")))
    assert got[0] == ("type ii diabetes", "type ii diabetes", "type-ii diabetes", "  type-ii  diabetes ")
    assert got[1][0] == "kidney disease diabetic" and got[2][0] == "strasse ünï"
    assert got[3] == ("", "", "", "") and got[4] == (None, None, "", None)


def test_normalizers_follow_unicode(spark):
    """Compatibility forms, folding, marks and other scripts: every key equals the exact one in Python."""
    forms = ["ﬁbrosis", "हिन्दी शब्द", "Straße_X", "T2D", "IL-6", "Type 2", "Ⅳ stage", "", "  ", "Ａlpha", "a.b", "²x", "İstanbul", "A\u2003B", "x" * 13, "ABC def GHI"]
    got = one(spark, "v string", [(f,) for f in forms], *[f(F.col("v")) for f in (text.alias_key, text.compact_key, text.looks_like_abbreviation, text.abbreviation_key, text.filter_text)])
    for form, keys in zip(forms, got):
        words = text.alias_words(form)
        assert keys == (" ".join(words), text.squeezed(form), text.is_brief(form), text.initials(words), text.compatible(form))
    assert text.alias_words("ﬁbrosis") == ["fibrosis"] and text.alias_words("हिन्दी") == ["ह", "न", "द"]
    ids = one(spark, "v string", [("ﬁbrosis",), ("Fibrosis ",)], hashing.entity_id(F.lit("D"), F.col("v")))
    assert ids[0] == ids[1]


def test_json_strings_and_six_digits(spark):
    values = ['a"b', "x\x0by", "\x1f", "tab\t", "\\u000B", "back\\\x0b", "é", "\n\r\b\f", ""]
    got = one(spark, "v string", [(v,) for v in values] + [(None,)], hashing.json_string(F.col("v")))
    assert [g[0] for g in got] == [json.dumps(v, ensure_ascii=False) for v in values] + [None]
    numbers = [0.9, 1.0, 123456.7, 1234567.0, 0.0001, 0.00001234, -2.5, 0.0, 1e20, 99999.95, 5e-324, float("inf"), float("nan")]
    got = one(spark, "v double", [(v,) for v in numbers] + [(None,)], text.six_digits(F.col("v")))
    assert [g[0] for g in got] == [f"{v:.6g}" for v in numbers] + [None]


def test_keys(spark):
    rows = [("type 2 diabetes mellitus",), ("T2DM",), ("kidney disease, diabetic",), ("Disease of the kidney",), ("",)]
    got = one(spark, "v string", rows, text.abbreviation_key(F.col("v")), text.compact_key(F.col("v")), text.token_set_key(F.col("v")), text.looks_like_abbreviation(F.col("v")))
    assert got[0] == ("t2dm", "type2diabetesmellitus", "2 diabetes mellitus type", False)
    assert got[1] == ("t", "t2dm", "t2dm", True) and got[2][2] == "diabetic disease kidney"
    assert got[3][0] == "dk" and got[4] == ("", "", "", False)


def test_offsets(spark):
    rows = [("the cat sat on the mat", "on the mat", "mat"), ("the cat", "gone", "cat"), ("the cat", "gone", "dog"), ("mat on the mat", "on the mat", "the")]
    got = one(spark, "c string, e string, m string", rows, text.mention_offset(F.col("c"), F.col("e"), F.col("m")))
    assert [g[0] for g in got] == [19, 4, None, 7]
    got = one(spark, "c string, s long", [("x" * 400 + "HIT", 400), ("abc", None)], text.context_window(F.col("c"), F.col("s"), F.lit("evidence")))
    assert got == [("x" * 350 + "HIT",), ("evidence",)]


def test_scores(spark):
    pairs = [("abcd", "bcde"), ("", ""), ("kidney disease", "disease kidney")]
    got = one(spark, "a string, b string", pairs, text.sequence_ratio(F.col("a"), F.col("b")), text.jaccard(text.tokens(F.col("a")), text.tokens(F.col("b"))))
    for (a, b), (ratio, _) in zip(pairs, got):
        assert abs(ratio - difflib.SequenceMatcher(None, a, b).ratio()) < 1e-12
    assert [g[1] for g in got] == [0.0, 0.0, 1.0]
    numbers = [(v,) for v in (0.9, 1.0, 0.0, 123456.7, 0.333333333, 12.5, -0.25, None)]
    got = one(spark, "v double", numbers, text.six_digits(F.col("v")))
    assert [g[0] for g in got] == [None if v is None else "%.6g" % v for (v,) in numbers]
    got = one(spark, "v string", [("abcd",), ("abcde",), ("日本",), ("",)], text.estimated_tokens(F.col("v")))
    assert [g[0] for g in got] == [1, 2, 2, 1]


def test_identifiers(spark):
    got = one(spark, "t string, n string", [("DISEASE", "Type-2 diabetes")], hashing.entity_id(F.col("t"), F.col("n")), hashing.percent_encoded(F.lit("a b~c/é*")))
    want = "ENT_" + hashlib.sha256(b"DISEASE\0type 2 diabetes").hexdigest()[:20].upper()
    assert got == [(want, "a%20b~c%2F%C3%A9%2A")]
    quals = {"Dose": " High  DOSE", "study_type": "x", "empty": " ", "none": None, 'q"': "a\\b"}
    canon = json.dumps({"Dose": "high dose", 'q"': "a\\b"}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    rows = [("S1", "treats", "O1", quals, True, False)]
    schema = "s string, r string, o string, q map<string,string>, n boolean, p boolean"
    c = [F.col(x) for x in "srqonp"]
    got = one(spark, schema, rows, hashing.canonical_qualifiers(c[2]), hashing.assertion_identity(c[0], c[1], c[3], hashing.canonical_qualifiers(c[2]), c[4], c[5]))
    whole = json.dumps({"subject": "S1", "relation": "treats", "object": "O1", "qualifiers": json.loads(canon), "negated": True, "speculative": False}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert got == [(canon, hashlib.sha256(whole.encode()).hexdigest())]


def test_nested_qualifiers(spark):
    rows = [('{"b": " X  y", "a": {"z": [3, "B", "a ", "", null], "e": {}}, "study_type": "rct", "t": true}',), (None,), ("{}",)]
    got = one(spark, "q string", rows, hashing.nested_qualifiers(F.col("q")))
    assert [g[0] for g in got] == ['{"a":{"z":["a","b",3]},"b":"x y","t":true}', "{}", "{}"]


def test_relation_phrases(spark):
    phrases = {
        "was independently associated with an increased risk of": ("increases_risk_of", 0.94),
        "was negatively associated with": ("negatively_associated_with", 0.92),
        "promoted the expression of": ("upregulates", 0.94),
        "was observed before": ("OTHER", 0.0),
        "Associated-With": ("associated_with", 1.0),
        "is associated with": ("OTHER", 0.0),
        "is linked to": ("associated_with", 0.88),
        "was treated by": ("treats", 0.92),
    }
    got = one(spark, "p string", [(p,) for p in phrases], relations.normalize_relation(F.col("p")).alias("r"))
    assert [(g[0].relation, g[0].confidence) for g in got] == list(phrases.values())
    got = one(spark, "p string", [("was treated by",)], relations.normalize_relation(F.col("p"), ["causes", "OTHER"]).alias("r"))
    assert got[0][0].relation == "OTHER"
