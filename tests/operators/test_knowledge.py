import pytest
from pyspark.sql import functions as F

from lodestone.operators import catalog, chunks, export, gold, jobs, quality, resolve, subgraph
from lodestone.streaming import events as streams


def test_chunks(spark):
    df = spark.createDataFrame([(1, "abcdefghij"), (2, ""), (3, None), (4, "abc")], "doc_id long, text string")
    got = [(r.doc_id, r.start, r.stop, r.chunk) for r in chunks.chunk_documents(df, 5, 1).orderBy("doc_id", "start").collect()]
    assert got == [(1, 0, 5, "abcde"), (1, 4, 9, "efghi"), (1, 8, 10, "ij"), (4, 0, 3, "abc")]
    assert chunks.chunk_documents(df, None).filter("doc_id = 2").count() == 1
    for bad in ((5, -1), (5, 5), (0, 0)):
        with pytest.raises(ValueError):
            chunks.chunk_spans(F.lit("x"), *bad)
    found = chunks.extract(chunks.chunk_documents(spark.createDataFrame([(1, "Aspirin treats pain. No. Metformin treats diabetes.")], "doc_id long, text string"), None), chunks.offline_extractor, "subject string, relation string, object string, evidence string, confidence double")
    assert sorted(r.subject for r in found.collect()) == ["Aspirin", "Metformin"]


def test_resolver_cascade(spark):
    known = spark.createDataFrame(
        [("DISEASE", "D1", "type II diabetes"), ("GENE", "G1", "ABC"), ("GENE", "G2", "ABC"), ("DISEASE", "D2", "diabetic kidney disease"), ("DISEASE", "D3", "chronic obstructive pulmonary disease")],
        "entity_type string, entity_id string, form string",
    )
    rows = [("DISEASE", "Type-II Diabetes", 1), ("GENE", "ABC", 2), ("DISEASE", "Kidney-disease diabetic", 3), ("PROTEIN", "Kidney-disease diabetic", 4), ("DISEASE", "T2DM", 5), ("PROTEIN", "T2DM", 6), ("DISEASE", "COPD", 7), ("DISEASE", "DKD", 8), ("DISEASE", "diabetes mellitus", 9)]
    got = {(r.entity_type, r.mention): (r.entity_id, r.method, r.confidence) for r in resolve.resolve(spark.createDataFrame(rows, "entity_type string, mention string, first_seen long"), known).collect()}
    assert got["DISEASE", "Type-II Diabetes"] == ("D1", "exact_alias", 1.0)
    assert got["GENE", "ABC"][1] == "new_entity" and got["PROTEIN", "Kidney-disease diabetic"][1] == "new_entity"
    assert got["DISEASE", "Kidney-disease diabetic"] == ("D2", "token_set", 1.0)
    assert got["DISEASE", "T2DM"] == ("D1", "known_synonym", 0.99) and got["PROTEIN", "T2DM"][1] == "new_entity"
    assert got["DISEASE", "COPD"] == ("D3", "abbreviation", 0.98) and got["DISEASE", "DKD"] == ("D2", "abbreviation", 0.98)
    assert got["DISEASE", "diabetes mellitus"][1] == "new_entity"


def test_candidates(spark):
    m = spark.createDataFrame([("D", "diabetes mellitus"), ("D", "T2DM")], "entity_type string, mention string")
    f = spark.createDataFrame([("D", "E1", "type 1 diabetes mellitus"), ("D", "E2", "type 2 diabetes mellitus"), ("D", "E3", "asthma"), ("X", "E4", "diabetes mellitus")], "entity_type string, entity_id string, form string")
    got = [(r.mention, r.entity_id, round(r.score, 2)) for r in resolve.candidates(m, f).orderBy("mention", "rank").collect()]
    assert ("T2DM", "E2", 0.98) in got and [g[1] for g in got if g[0] == "diabetes mellitus"] == ["E1", "E2"]


def test_facts(spark):
    rows = [
        (1, "T2DM", "is treated with", "metformin", {"dose": "High "}, False, False, "doc-1", "research", 0.95, "e1"),
        (2, "T2DM", "was treated by", "metformin", {"dose": "high", "study_type": "rct"}, False, False, "doc-2", "research", 1.7, "e2"),
        (3, "T2DM", "was treated by", "metformin", {"dose": "low"}, False, False, "doc-2", "research", None, "e3"),
    ]
    raw = spark.createDataFrame(rows, "raw_id long, subject_entity string, phrase string, object_entity string, qualifiers map<string,string>, negated boolean, speculative boolean, document_id string, source string, confidence double, evidence_text string")
    ided = gold.identify_facts(raw)
    facts = {r.first_raw_id: r for r in gold.aggregate_facts(ided).collect()}
    assert set(facts) == {1, 3} and facts[1].relation == "treats" and facts[1].support_count == 2 and facts[1].document_count == 2
    assert gold.evidence(ided).count() == 3
    view = {r.edge_confidence for r in gold.edge_view(gold.aggregate_facts(ided)).collect()}
    assert view == {0.95, 1.0}
    links = gold.evidence(ided)
    first = facts[1].identity
    found = gold.evidence_lookup(links, spark.createDataFrame([("doc-1", "a"), ("doc-2", "b")], "document_id string, title string"), raw, first).collect()
    assert [r.raw_id for r in found] == [2, 1]
    assert gold.insert_absent(raw.filter("raw_id = 1"), raw, ["raw_id"]).count() == 2
    assert gold.support(gold.aggregate_facts(ided).drop("support_count"), links).agg(F.sum("support_count")).first()[0] == 3


def test_joins_of_mentions_and_projections(spark):
    raw = spark.createDataFrame([(1, "m1", "m2"), (2, "m1", "m9")], "raw_id long, subject_mention string, object_mention string")
    res = spark.createDataFrame([("m1", "E1"), ("m2", "E2")], "mention_id string, entity_id string")
    assert [(r.raw_id, r.subject_entity, r.object_entity) for r in gold.resolve_assertions(raw, res).collect()] == [(1, "E1", "E2")]
    facts = spark.createDataFrame([("f1", "E1", "E2"), ("f2", "E1", "E7")], "identity string, subject_entity string, object_entity string")
    names = spark.createDataFrame([("E1", "one"), ("E2", "two")], "entity_id string, name string")
    links = spark.createDataFrame([("f1", 1), ("f1", 2), ("f2", 3)], "identity string, raw_id long")
    assert [(r.identity, r.object_entity_name, r.evidence_count) for r in export.projected_edges(facts, names, links).collect()] == [("f1", "two", 2)]
    seen = spark.createDataFrame([("d", "same", 1, 0), ("d", "same", 0, 3), ("d", "other", 0, 1)], "document_id string, assertion string, chunk_index int, position int")
    assert sorted((r.assertion, r.chunk_index, r.position) for r in chunks.distinct_assertions(seen).collect()) == [("other", 0, 1), ("same", 0, 3)]


def test_graph_statistics(spark):
    edges = spark.createDataFrame([("t2d", "metformin", "treats"), ("t2d", "obesity", "associated_with"), ("isolated-a", "isolated-b", "OTHER")], "source string, target string, relation string")
    docs = spark.createDataFrame([("t2d", "doc-1"), ("t2d", "doc-2"), ("metformin", "doc-1")], "entity_id string, document_id string")
    totals = spark.createDataFrame([(12, 5, 5)], "mentions long, entities long, evidence long")
    assert tuple(quality.graph_quality(edges, docs, totals).first()) == (0.3333, 0.6, 2.4, 0.2, 0.3333, 0.4)
    empty = quality.graph_quality(edges.limit(0), docs.limit(0), totals.selectExpr("mentions * 0 as mentions", "entities * 0 as entities", "evidence * 0 as evidence"))
    assert set(empty.first()) == {None}


def test_jobs(spark):
    docs = spark.createDataFrame([("d1",), ("d2",)], "document_id string")
    none = spark.createDataFrame([], "document_id string, stage string, stage_version string")
    made = jobs.enqueue(none, docs, ["extract"], "v1")
    assert made.count() == 2 and jobs.enqueue(made, docs, ["extract"], "v1").count() == 0
    table = made.withColumns({"job_id": F.row_number().over(__import__("pyspark.sql", fromlist=["Window"]).Window.orderBy("document_id")), "error": F.lit(None).cast("string"), "retry_count": F.lit(0)})
    claimed = jobs.claim(table, 1, "w1", F.lit("2024-01-01 00:00:00").cast("timestamp"), 60)
    assert [(r.document_id, r.status) for r in claimed.collect()] == [("d1", "RUNNING")]
    failed = jobs.fail(table, spark.createDataFrame([(1, "x" * 30000)], "job_id int, message string"))
    row = failed.filter("job_id = 1").first()
    assert (row.status, row.retry_count, len(row.error)) == ("FAILED", 1, 20000)
    assert jobs.retry_failed(failed, "ext").filter("status = 'FAILED'").count() == 0
    todo, done = jobs.reusable_chunks(table.select("document_id"), table.selectExpr("document_id", "if(document_id = 'd1', 'SUCCESS', 'FAILED') as status"), ["document_id"])
    assert todo.first()[0] == "d2" and done.first()[0] == "d1"
    assert jobs.backoff_seconds(0, 1) == 1 and jobs.backoff_seconds(9, 1) == 60 and jobs.backoff_seconds(0, 1, 7) == 7
    assert jobs.is_retryable(429) and jobs.is_retryable(503) and not jobs.is_retryable(404) and jobs.is_retryable(None, True)
    req = [(float(t), 20_000) for t in (0, 0, 0, 10)]
    waits = [round(r.wait, 3) for r in jobs.rate_limit_schedule(spark.createDataFrame(req, "t double, tokens int"), 100, 1_000_000).orderBy("scheduled").collect()]
    assert waits == [0, 1.2, 2.4, 0]


def test_catalog_state(spark):
    d = spark.createDataFrame([(i, n) for i, n in enumerate([5, 4, 20, 3, 3, 1])], "id long, n int")
    got = [r.batch for r in catalog.greedy_batches(d, F.col("n"), 12, ["id"]).orderBy("id").collect()]
    assert got == [0, 0, 1, 2, 2, 2]
    batched = catalog.screening_batches(d.withColumn("text", F.col("n").cast("string")), ["id"], 4)
    assert sorted(r.id for r in catalog.screen(batched, lambda texts: [1, 2]).collect()) == [0, 1, 4, 5]
    with pytest.raises(ValueError):
        catalog.require_filter(False, False, False, False)
    w = spark.createDataFrame([("a", " ", "full", False, False), ("b", "abs", None, False, False), ("c", "abs", None, True, False), ("d", None, None, False, True)], "id string, abstract string, fulltext string, abstract_processed boolean, fulltext_processed boolean").withColumn("fulltext_status", F.lit(None).cast("string"))
    plan = lambda mode: {r.id: r.action for r in catalog.materialization_plan(w, mode).collect()}
    assert plan("abstract") == {"a": "no_content", "b": "batch", "c": "skip", "d": "no_content"}
    assert plan("fulltext-or-abstract") == {"a": "document", "b": "batch", "c": "not_found", "d": "skip"}
    assert plan("fulltext")["b"] == "not_found"


def test_typed_subgraph(spark):
    kind = subgraph.EdgeType("disease_gene", "disease", "gene", ("-weight",))
    rows = [("d1", f"g{i}", "r", float(i)) for i in range(5)] + [("d2", "g4", "r", 1.0), ("d3", "g0", "r", 1.0)]
    seeds = spark.createDataFrame([("disease", "d1")], "type string, id string")
    tables = {kind: spark.createDataFrame(rows, "`from` string, `to` string, relation string, weight double")}
    nodes, edges = subgraph.traverse(tables, seeds, 2, 3)
    assert {(r.id, r.hop) for r in nodes.collect()} == {("d1", 0), ("g4", 1), ("g3", 1), ("g2", 1)}
    assert edges.count() == 3 and not any(subgraph.violations(nodes, edges, seeds, 2, 3).values())
    nodes, edges = subgraph.traverse(tables, seeds, 2, 0)
    assert {r.id for r in nodes.filter("hop = 2").collect()} == {"d2", "d3"} and edges.count() == 7
    people = spark.createDataFrame([("EFO_1", "Diabetes Mellitus", ["x"]), ("MONDO_2", "other", ["type 1 diabetes"]), ("Z", "asthma", None)], "id string, name string, synonyms array<string>")
    got = [(r.id, r.matched_fields, r.selection_score) for r in subgraph.candidate_scores(people, "diabetes", "diabetes mellitus", ["name", "synonyms"]).collect()]
    assert got == [("EFO_1", "name", 1120), ("MONDO_2", "synonyms", 10)]


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("a", 0.9, True, None), ("b", None, False, 3)], "id string, confidence double, flag boolean, n int")
    export.write_tsv(df, str(tmp_path / "t"))
    text = next((tmp_path / "t").glob("part-*")).read_text()
    assert text.splitlines()[:2] == ["id\tconfidence\tflag\tn", "a\t0.9\ttrue\t"]
    back = {r.id: r for r in export.read_tsv(spark, str(tmp_path / "t"), ("flag",), ("n",), "confidence").collect()}
    assert back["a"].flag is True and back["b"].confidence == 1.0 and back["b"].n == 3
    export.write_manifest(spark, str(tmp_path / "m.json"), {"b": 1, "a": 2})
    assert (tmp_path / "m.json").read_text().index('"a"') < (tmp_path / "m.json").read_text().index('"b"')
    assert export.label("2 x") == "SQL_T_2_x"


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, f"2024-01-0{1 + i % 3} 00:00:00", "ab"[i % 2], float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "event_id long, t string, event_type string, value double").withColumn("ts", F.col("t").cast("timestamp")).drop("t")
    df.write.parquet(str(tmp_path / "in"))
    q = streams.windowed_counts(streams.event_stream(spark, str(tmp_path / "in"), df.schema), lateness="1 day").writeStream.outputMode("complete").format("memory").queryName("seen").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(spark.table("seen").collect()) == sorted(streams.windowed_counts(df).collect())
