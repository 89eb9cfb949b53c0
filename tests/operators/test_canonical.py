import difflib
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from lodestone import settings
from lodestone.functions import text
from lodestone.operators import canonical, catalog, chunks, export, jobs, layered, resolve, statistics, subgraph

BASE = ["oesophagitis", "esophagitis", "type 2 diabetes mellitus", "t2dm", "T2D", "diabetes mellitis", "diabetesmellitis", "diabetes mellitus", "hypertension", "ypertension", "IL-6", "interleukin 6", "chronic kidney disease", "CKD", "kidney disease chronic", "a", "heart failure", "failure of heart"]


def changed(rng, word):
    letters = list(word)
    for _ in range(rng.randint(0, 3)):
        at, what = rng.randrange(len(letters) + 1), rng.random()
        if what < 0.4 and letters:
            letters.pop(min(at, len(letters) - 1))
        elif what < 0.8:
            letters.insert(at, rng.choice("abcde "))
    return "".join(letters) or "x"


def best_score(mention, forms):
    key, best = " ".join(text.alias_words(mention)), 0.0
    for form in forms:
        other = " ".join(text.alias_words(form))
        if key and key == other:
            return 1.0
        if (text.is_brief(mention) or text.is_brief(form)) and (text.squeezed(mention) == text.initials(other.split()) or text.squeezed(form) == text.initials(key.split())):
            return 0.98
        a, b = set(key.split()), set(other.split())
        best = max(best, 0.6 * (len(a & b) / len(a | b) if a | b else 0) + 0.4 * difflib.SequenceMatcher(None, key, other).ratio())
    return best


def test_candidates_equal_all_pairs(spark):
    rng = random.Random(3)
    forms = [(f"E{i // 2:03d}", changed(rng, rng.choice(BASE)), i % 2) for i in range(200)]
    mentions = {changed(rng, rng.choice(BASE)) for _ in range(60)} | {"oesophagitis"}
    entities = {}
    for e, f, p in forms:
        entities.setdefault(e, []).append((p, f))
    want = {}
    for m in mentions:
        scored = sorted((-s, e) for e, fs in entities.items() if (s := best_score(m, [f for _, f in sorted(fs)])) >= 0.35)[:8]
        want[m] = [(e, round(-s, 9)) for s, e in scored]
    got = {m: [] for m in mentions}
    found = resolve.candidates(spark.createDataFrame([("D", m) for m in mentions], "entity_type string, mention string"), spark.createDataFrame([("D", *f) for f in forms], "entity_type string, entity_id string, form string, position int"))
    for r in sorted(found.collect(), key=lambda r: r.rank):
        got[r.mention].append((r.entity_id, round(r.score, 9)))
    assert got == want


def test_communities_do_not_change_the_cascade(spark):
    rng = random.Random(4)
    rows = [("DISEASE" if i % 3 else "G", changed(rng, rng.choice(BASE)), i) for i in range(200)]
    out = {(r.entity_type, r.mention): (r.entity_id, r.method) for r in resolve.resolve(spark.createDataFrame(rows, "entity_type string, mention string, first_seen int")).collect()}
    for kind in ("DISEASE", "G"):
        index, seen = resolve.Index(kind), {}
        for k, m, i in rows:
            if k == kind:
                seen[m] = min(i, seen.get(m, i))
        for m in sorted(seen, key=lambda m: (seen[m], m)):
            key = " ".join(text.alias_words(m.strip(" ")))
            name = next((names[0] for k, names in resolve.SYNONYMS if k == kind and key in names), key)
            own = "ENT_" + hashlib.sha256(f"{kind}\0{' '.join(text.alias_words(name))}".encode()).hexdigest()[:20].upper()
            entity, method = index.find(m)
            entity, method = (entity, method) if entity else (own, "new_entity")
            index.add(entity, m)
            assert out[kind, m] == (entity, method)


def test_decisions(spark):
    rows = [("a", ["E1", "E2"], ("MATCH", "E1", None, 0.9)), ("b", ["E1"], ("MATCH", "E9", None, 0.99)), ("c", ["E1"], ("MATCH", "E1", None, 0.5)), ("d", [], ("NEW", None, "Better name", 0.9)), ("e", [], ("NEW", None, "Unsure name", 0.3))]
    schema = "mention string, candidates array<string>, decision struct<decision:string,entity_id:string,canonical_name:string,confidence:double>"
    df = spark.createDataFrame(rows, schema).withColumn("entity_type", F.lit("X"))
    got = {r.mention: r for r in resolve.decide(df).collect()}
    assert got["a"].entity_id == "E1" and got["a"].method == "semantic_match"
    assert {got[m].method for m in "bcde"} == {"semantic_new"} and {m: got[m].name for m in "bcde"} == {"b": "b", "c": "c", "d": "Better name", "e": "e"}
    bad = spark.createDataFrame([("x", [], ("MATCH", None, None, 2.0))], schema)
    assert bad.select(resolve.decision_violations(F.col("decision"))).first()[0] == ["entity_id", "confidence"]


def knowledge(spark):
    mentions = [("m1", "Type 2 diabetes", "DISEASE"), ("m2", "metformin", "DRUG"), ("m3", "T2D", "DISEASE"), ("m4", "Metformin ", "DRUG"), ("m5", "never named", "DRUG")]
    raw = [(1, "m1", "m2", "is treated with", {"dose": "High "}, "d1", 0.9), (2, "m3", "m4", "was treated by", {"dose": "high"}, "d2", 0.7), (3, "m1", "m2", "is treated with", {"dose": "low"}, "d2", None)]
    m = spark.createDataFrame(mentions, "mention_id string, mention_text string, entity_type string")
    r = spark.createDataFrame([(str(i), s, o, p, q, False, False, d, "s", "e", c) for i, s, o, p, q, d, c in raw], "raw_id string, subject_mention string, object_mention string, phrase string, qualifiers map<string,string>, negated boolean, speculative boolean, document_id string, source string, evidence_text string, confidence double")
    return m, r


@pytest.mark.parametrize("size", [2, 100])
def test_canonicalization_runs_resumes_and_resets(spark, tmp_path, size):
    m, r = knowledge(spark)
    store = canonical.Store(spark, f"file://{tmp_path}/store")
    first = canonical.canonicalize(store, m, r.filter("raw_id = '1'"), mention_batch=size, assertion_batch=size)
    assert (first["entities_created"], first["facts_created"], first["evidence_created"], first["mentions_considered"]) == (2, 1, 1, 2)
    second = canonical.canonicalize(store, m, r, mention_batch=size, assertion_batch=size)
    assert (second["entities_created"], second["resolutions_created"], second["facts_created"], second["evidence_created"]) == (0, 2, 1, 2)
    found = {x.mention_id: (x.entity_id, x.method) for x in store.table("resolutions").collect()}
    assert found["m3"] == (found["m1"][0], "abbreviation") and found["m4"][0] == found["m2"][0] and "m5" not in found
    batches = store.commits()
    again = canonical.canonicalize(store, m, r, mention_batch=size, assertion_batch=size)
    assert store.commits() == batches and not any(n for k, n in again.items() if k.endswith("_created"))
    whole = canonical.Store(spark, f"file://{tmp_path}/whole")
    canonical.canonicalize(whole, m, r)
    for name in ("facts", "evidence", "resolutions"):
        assert sorted(map(tuple, store.table(name).collect())) == sorted(map(tuple, whole.table(name).collect()))
    store.reset()
    assert store.commits() == [] and store.table("facts").count() == 0


def test_half_a_batch_does_not_count(spark, tmp_path):
    m, r = knowledge(spark)
    store = canonical.Store(spark, f"file://{tmp_path}/store")
    canonical.canonicalize(store, m, r)
    done = sorted(map(tuple, store.table("facts").collect()))
    (tmp_path / "store/commits" / store.commits()[-1]).unlink()
    canonical.canonicalize(store, m, r)
    assert sorted(map(tuple, store.table("facts").collect())) == done


def test_key_faults(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 2.0), (None, 0.1)], "id long, confidence double")
    got = {(r.rule, r["rows"]) for r in canonical.key_faults({"t": df}, {"t": ["id"]}, {"t": {"range": "confidence between 0 and 1"}}).collect()}
    assert got == {("unique(id)", 1), ("not null(id)", 1), ("confidence between 0 and 1", 1)}


def test_statistics_document(spark):
    t = spark.createDataFrame
    tables = {
        "documents": t([("d1", "research"), ("d2", "research"), ("d3", "textbook")], "document_id string, source_type string"),
        "processing_jobs": t([("x", "v1", "FAILED"), ("x", "v1", "SUCCESS"), ("y", "v1", "SUCCESS")], "stage string, stage_version string, status string"),
        "entity_mentions": t([("A", "D"), ("a", "D"), ("b", "G")], "mention_text string, entity_type string"),
        "raw_assertions": t([("d1", True), ("d1", False), ("d2", True)], "document_id string, evidence_validated boolean"),
        "entities": t([("E1",), ("E2",)], "entity_id string"),
        "assertions": t([("E1", "E2", "treats")], "source string, target string, relation string"),
        "entity_documents": t([("E1", "d1"), ("E1", "d2")], "entity_id string, document_id string"),
        "entity_resolutions": t([("m",)] * 3, "mention_id string"),
        "assertion_evidence": t([("e",)] * 2, "raw_id string"),
    }
    doc = json.loads(statistics.as_json(statistics.knowledge_statistics(tables)))
    assert doc["documents"] == {"total": 3, "revisions": 0, "by_source_type": {"research": 2, "textbook": 1}}
    assert doc["processing_jobs"]["by_status"] == {"FAILED": 1, "SUCCESS": 2} and len(doc["processing_jobs"]["details"]) == 3
    assert doc["bronze_knowledge"]["unique_mention_texts"] == 2 and doc["bronze_knowledge"]["evidence_not_validated"] == 1
    assert doc["quality"] == {"invalid_records": 0, "evidence_validation_rate": 0.6667}
    assert doc["graph_quality"]["reuse_ratio"] == 0.5 and doc["graph_quality"]["compression"] == 1.5
    bare = json.loads(statistics.as_json(statistics.knowledge_statistics({"documents": tables["documents"]})))
    assert bare["quality"]["evidence_validation_rate"] is None and bare["graph_quality"]["reuse_ratio"] is None


def test_catalog_selection_of_explicit_works(spark):
    known = spark.createDataFrame([("W1", "a", "filter", False, True)], "work_id string, title string, method string, selected boolean, processed boolean")
    snap = spark.createDataFrame([("W2", "b"), ("W3", "c")], "work_id string, title string")
    ids = spark.createDataFrame([("W1",), ("W2",)], "work_id string")
    got = {r.work_id: (r.title, r.method, r.selected, r.processed) for r in catalog.add_works(known, snap, ids).collect()}
    assert got == {"W1": ("a", "manual", True, True), "W2": ("b", "manual", True, False)}
    with pytest.raises(LookupError, match="W8, W9"):
        catalog.add_works(known, snap, spark.createDataFrame([("W9",), ("W8",)], "work_id string"))
    rows = spark.createDataFrame([(i, i % 7 == 0) for i in range(100)], "id int, wanted boolean")
    out = catalog.capped_selection(rows, F.col("id") % 2 == 1, ["id"], F.col("wanted"), 20, 15).orderBy("id").collect()
    explicit = [i for i in range(100) if i % 7 == 0]
    passing = [i for i in range(100) if i % 2 and i % 7][:20]
    seen = sorted(explicit + passing)
    assert [r.id for r in out] == seen and [r.id for r in out if r.selected] == sorted(set(explicit) | set(seen[:15]))


def test_documents_of_works(spark):
    works = spark.createDataFrame([("W1", "t1", None, "short", "full text"), ("W2", "t2", "10.1", "x" * 50, None), ("W3", "t3", None, "y" * 50, " "), ("W4", "t4", None, " ", None)], "work_id string, title string, doi string, abstract string, fulltext string")
    (one,) = catalog.fulltext_documents(works).collect()
    assert (one.document_id, one.content) == ("W1", "full text") and json.loads(one.payload)["content_mode"] == "fulltext"
    docs = sorted(catalog.abstract_documents(works, 200, ["work_id"]).collect(), key=lambda r: r.work_ids)
    assert [r.work_ids for r in docs] == [["W1", "W2"], ["W3"]]
    assert docs[0].document_id == "abstract-batch:" + hashlib.sha256(docs[0].content.encode()).hexdigest()[:24]
    marked = catalog.mark_materialized(works, spark.createDataFrame([("W1", "/p", True)], "work_id string, path string, processed boolean"), "fulltext")
    assert {(r.work_id, r.fulltext_path, r.fulltext_processed) for r in marked.collect()} == {("W1", "/p", True), ("W2", None, False), ("W3", None, False), ("W4", None, False)}
    runs = catalog.log_run(spark.createDataFrame([], catalog.RUNS), "r1", {"all": True}, "t0")
    runs = catalog.log_run(runs, "r1", {"all": True}, "t0", "t1", scanned=5)
    assert [(r.finished, r.counters) for r in runs.collect()] == [("t1", {"scanned": 5})]


def test_passages_equal_brute_force(spark):
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "x"]
    docs = [(i % 30, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) if i % 9 else None) for i in range(60)]
    passages = [(i, t[a : a + rng.randint(0, 60)]) for i in range(60) for t in [rng.choice(docs)[1] or "none"] for a in [rng.randint(0, 20)]] + [(99, None), (98, "alpha  beta gamma delta x"), (97, "")]
    got = sorted((r.item_id, r.doc_id, r.offset) for r in chunks.find_passages(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(passages, "item_id int, passage string"), "doc_id", "item_id").collect())
    want = sorted((i, d, t.find(p) if p else None) for i, p in passages if p is not None for d, t in docs if t is not None and p in t)
    assert sorted(got, key=str) == sorted(want, key=str)


def test_extraction_is_persisted(spark):
    docs = spark.createDataFrame([("d1", "We saw that aspirin treats pain. Aspirin again.")], "document_id string, content string")
    rows = [("d1", "aspirin", "DRUG", "treats", "pain", "SYMPTOM", "aspirin treats pain", 0.9, 0, 0), ("d1", "aspirin", "DRUG", "treats", "pain", "SYMPTOM", "aspirin treats pain", 0.4, 1, 0), ("d1", "pain", "SYMPTOM", "needs", "rest", "OTHER", "not there", 0.5, 0, 1)]
    out = spark.createDataFrame(rows, "document_id string, subject string, subject_type string, relation string, object string, object_type string, evidence string, confidence double, chunk_index int, position int")
    mentions, assertions = chunks.persist(out, docs)
    spans = {(r.mention_text, r.entity_type): (r.character_start, r.character_end) for r in mentions.collect()}
    assert spans == {("aspirin", "DRUG"): (12, 19), ("pain", "SYMPTOM"): (27, 31), ("rest", "OTHER"): (None, None)}
    assert sorted((r.phrase, r.confidence, r.evidence_validated) for r in assertions.collect()) == [("needs", 0.5, False), ("treats", 0.9, True)]


def test_export_views_and_sinks(spark, tmp_path):
    nodes = spark.createDataFrame([(f"n{i:02d}", "L", "t", json.dumps({"title": f"T{i}"} if i % 2 else {"entity_type": "K"})) for i in range(40)], "node_key string, label string, kind string, properties string")
    edges = spark.createDataFrame([(f"e{i}", f"n{i:02d}", f"n{i + 1:02d}", "raw") for i in range(5)], "edge_key string, source_key string, target_key string, layer string")
    for limit, n in ((3, 4), (10, 10), (100, 40)):
        shown, kept = export.graph_view(nodes, edges, "all", limit)
        assert (shown.count(), kept.count()) == (n, min(5, limit))
    assert export.graph_view(nodes, edges, "raw", 100)[0].count() == 6 and export.graph_view(nodes, edges, "canonical", 100)[0].count() == 0
    named = {r.id: (r.label, r.kind) for r in export.web_nodes(nodes).collect()}
    assert named["n01"] == ("T1", "t") and named["n02"] == ("t", "K")
    new = nodes.filter("node_key = 'n01'").withColumn("properties", F.lit("{}"))
    assert export.merge_nodes(nodes, new).filter("properties = '{}'").count() == 1 and export.delete_rows(nodes, new, ["node_key"]).count() == 39
    small = spark.createDataFrame([("disease", "d", 0)], "type string, id string, hop int"), spark.createDataFrame([("x", "d", "e", 1, ["a"])], "edge_type string, `from` string, `to` string, hop int, tags array<string>")
    export.write_subgraph(*small, f"file://{tmp_path}/g", {"root": "d"})
    summary = json.loads((tmp_path / "g/summary.json").read_text())
    assert summary["nodes"]["total"] == 1 and summary["root"] == "d" and spark.read.parquet(f"{tmp_path}/g/edges.parquet").count() == 1
    export.write_descriptor(spark, f"file://{tmp_path}/g/graph.yaml", "g", {"nodes": "nodes.tsv"}, {"hops": 2, "seeds": ["a", "b"]})
    assert (tmp_path / "g/graph.yaml").read_text() == 'name: "g"\nfiles:\n  nodes: "nodes.tsv"\nsettings:\n  hops: 2\n  seeds:\n    - "a"\n    - "b"\n'
    tables = {"t": spark.createDataFrame([(1, None, bytearray(b"x"))], "id int, note string, body binary")}
    assert [(r.column, r.key_position) for r in export.describe(tables, {"t": ["id"]}).orderBy("position").collect()] == [("id", 1), ("note", 0), ("body", 0)]
    assert export.sample_rows(tables, 1).count() == 1 and tables["t"].select(export.null_columns(tables["t"])).first()[0] == '["note"]'
    assert tables["t"].select(export.property_value(F.col("body"), "binary")).first()[0] == "base64:eA=="
    assert export.references([("a", ["x"], "t"), ("t", ["id"], "gone")], tables | {"a": tables["t"]}, {"t": ["id"]}) == [export.ForeignKey("a", ("x",), "t", ("id",))]
    shown = export.show(spark.createDataFrame([("w", '{"k": [1]}')], "id string, options_json string"), "id", "w")
    assert shown == {"id": "w", "options_json": {"k": [1]}} and export.show(nodes, "node_key", "no") is None


def test_seeds_attributes_and_keywords(spark):
    found = spark.createDataFrame([("b", 1), ("a", 0)], "id string, n int")
    assert subgraph.root_of(found) == "b" and subgraph.root_of(found, "a") == "a"
    with pytest.raises(LookupError):
        subgraph.root_of(found, "z")
    nodes = spark.createDataFrame([("disease", "d1", 0), ("gene", "g1", 1)], "type string, id string, hop int")
    got = {r.id: r.attributes for r in subgraph.with_attributes(nodes, {"disease": spark.createDataFrame([("d1", "Name")], "id string, name string")}).collect()}
    assert got == {"d1": '{"name":"Name"}', "g1": None}
    seeds = nodes.select("type", "id").limit(1)
    assert [df.count() for df in subgraph.traverse({}, seeds, 2)] == [1, 0]
    assert [tuple(r) for r in layered.keywords_of(spark.createDataFrame([("b", "e"), ("a", "e"), ("b", "e")], "keyword string, entity_id string")).collect()] == [("e", "a|b")]
    ids = spark.createDataFrame([("e", False, "A:1"), ("e", True, "Z:9"), ("f", False, "C:2"), ("f", False, "B:3")], "entity_id string, is_primary boolean, normalized_id string")
    assert sorted(tuple(r) for r in layered.primary_ids(ids).collect()) == [("e", "Z:9"), ("f", "B:3")]
    assert sum(b.count() for b in layered.in_blocks(ids, 3)) == 4


def test_job_states(spark, tmp_path):
    rows = [(i, f"d{i}", "x", "v1", "PENDING") for i in range(3)]
    table = spark.createDataFrame(rows, "job_id int, document_id string, stage string, stage_version string, status string")
    claimed = jobs.claim(table, 2, "w", F.lit("2024-01-01 00:00:00").cast("timestamp"), 60)
    state = jobs.commit_claim(table, claimed, f"file://{tmp_path}/jobs", 1)
    assert sorted((r.job_id, r.status) for r in state.collect()) == [(0, "RUNNING"), (1, "RUNNING"), (2, "PENDING")]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        jobs.commit_claim(table, claimed, f"file://{tmp_path}/jobs", 1)
    stored = spark.createDataFrame([("a", "SUCCESS", "out"), ("b", "FAILED", None), ("z", "SUCCESS", "old")], "chunk string, status string, output string")
    got = {r.chunk: (r.status, r.output) for r in jobs.prepare_chunks(spark.createDataFrame([("a",), ("b",), ("c",)], "chunk string"), stored, ["chunk"]).collect()}
    assert got == {"a": ("SUCCESS", "out"), "b": ("PENDING", None), "c": ("PENDING", None)}
    assert sorted((r.stage, r.status, r.jobs) for r in jobs.status_totals(state).collect() if r.stage) == [("x", "PENDING", 1), ("x", "RUNNING", 2)]
    one = jobs.run_statistics(state.withColumn("status", F.lit("SUCCESS")), spark.createDataFrame([(5, 2), (1, 1)], "input_tokens int, output_tokens int")).first()
    assert tuple(one) == (3, 0, 2, 6, 3)


def test_settings_and_answers():
    assert settings.expand("a ${X:-b} ${Y}", {"Y": "c"}) == "a b c"
    with pytest.raises(KeyError):
        settings.expand("${NO}", {})
    with pytest.raises(ValueError, match="source keywords.*mode"):
        settings.NetworkSettings((" ",), ("x",), mode="both")
    assert settings.stage_version("v1", {"b": "2", "a": "1"}, (100, 5)) == "v1;a=1;b=2;chunk=100/5"
    with pytest.raises(ValueError):
        settings.stage_version("v" * 129, {})
    assert settings.parse_model_output('```json\n{"assertions": [{"qualifiers": null}]}\n```') == {"assertions": [{"qualifiers": {}}]}
    asked = []

    def call(question):
        asked.append(question)
        return '{"ok": %s}' % ("true" if len(asked) > 1 else "false")

    def check(answer):
        if not answer["ok"]:
            raise ValueError("not ok")

    assert settings.ask(call, check, "q") == {"ok": True} and "not ok" in asked[1]
    with pytest.raises(ValueError):
        settings.ask(lambda q: "[]", check, "q")
