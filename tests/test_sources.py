import gzip
import json

import pytest
from pyspark.sql import functions as F

from lodestone.operators import catalog
from lodestone.sources import landing, snapshot


def work(n, title, field, **more):
    return {"id": f"https://x.org/W{n}", "title": title, "topics": [{"id": "T1", "field": {"id": f"https://x.org/fields/{field}"}}], "publication_year": 2020, "abstract_inverted_index": {"world": [1], "hello": [0, 2]}, **more}


@pytest.fixture
def root(tmp_path):
    part = tmp_path / "data/works/updated_date=2024-01-01"
    part.mkdir(parents=True)
    lines = [json.dumps(work(1, "Diabetes voice", 27, has_content={"pdf": True, "grobid_xml": False})), "", json.dumps(work(2, "Astronomy", 17)), json.dumps(work(3, "Diabetes review", 27, publication_year="n/a")), json.dumps({"id": "bad", "title": "x"})]
    (part / "part_0000.gz").write_bytes(gzip.compress("\n".join(lines).encode()))
    (part / "part_0001.gz").write_bytes(gzip.compress(json.dumps(work(4, "Unlisted", 27)).encode()))
    (part / "part_0000.gz.BAD123").write_bytes(b"junk")
    (tmp_path / "data/works/manifest").write_text(json.dumps({"entries": [{"url": "s3://b/data/works/updated_date=2024-01-01/part_0000.gz"}]}))
    return tmp_path


def test_manifest_scan_and_gate(spark, root):
    parts = snapshot.part_files(spark, str(root), "works")
    assert [r.relative for r in parts.collect()] == ["updated_date=2024-01-01/part_0000.gz"]
    scanned = snapshot.scan(spark, parts)
    assert [r.line for r in scanned.orderBy("line").collect()] == [1, 3, 4, 5]
    works = snapshot.works(scanned)
    rows = {r.work_id: r for r in works.collect()}
    assert set(rows) == {"W1", "W2", "W3"} and rows["W1"].abstract == "hello world hello"
    assert rows["W1"].fields == [27] and rows["W3"].year is None and rows["W1"].has_pdf and not rows["W2"].has_pdf
    ok, _ = catalog.work_gate(F.col("title"), F.col("abstract"), F.col("fields"), allowed_fields=catalog.DEFAULT_FIELDS)
    assert {r.work_id for r in works.filter(ok).collect()} == {"W1", "W3"}
    ok, hit = catalog.work_gate(F.col("title"), F.col("abstract"), any_of=["DIABETES", " "], exclude=["review"])
    assert [(r.work_id, r.hit) for r in works.filter(ok).select("work_id", hit.alias("hit")).collect()] == [("W1", ["DIABETES"])]
    assert snapshot.works(scanned, 2).count() == 2
    (root / "data/works/manifest").write_text("{}")
    assert snapshot.part_files(spark, str(root), "works").count() == 2
    assert snapshot.compressed_size(parts).first().bytes > 0


def test_truncated_part_keeps_what_was_read(spark, root):
    path = root / "data/works/updated_date=2024-01-01/part_0000.gz"
    lines = [json.dumps(work(n, "x" * 20000 + str(n), 27)) for n in range(1, 4)]
    whole = gzip.compress("\n".join(lines).encode(), compresslevel=0)
    path.write_bytes(whole[: len(whole) // 2])
    scanned = snapshot.scan(spark, snapshot.part_files(spark, str(root), "works"))
    assert scanned.filter("record is not null").count() == 1
    (bad,) = snapshot.failures(scanned).collect()
    assert (bad.error, bad.records_read) == ("EOFError", 1)


def test_landing(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("plain text")
    (tmp_path / "sub/b.JSON").write_text(json.dumps({"document_id": "own", "text": "body", "title": "T", "source_type": "guidelines"}))
    (tmp_path / "c.md").write_text("  ")
    (tmp_path / "d.json").write_text("[1]")
    (tmp_path / "e.csv").write_text("x")
    rows = {r.document_id: r for r in landing.load_documents(spark, str(tmp_path)).collect()}
    assert set(rows) == {"a.txt", "own", "c.md", "d.json"} and landing.count(spark, str(tmp_path)) == 4
    assert (rows["a.txt"].title, rows["a.txt"].content, rows["own"].source_type) == ("a", "plain text", "guidelines")
    assert rows["c.md"].error == "content is blank" and rows["d.json"].error
    with pytest.raises(ValueError):
        landing.discover(spark, str(tmp_path / "e.csv"))


def test_fulltexts(spark, tmp_path):
    (tmp_path / "W1.xml.gz").write_bytes(gzip.compress(b"<a> one <b>two</b></a>"))
    (tmp_path / "W1.txt").write_text("plain")
    (tmp_path / "W2.json").write_text(json.dumps({"content": "json body"}))
    (tmp_path / "W9.txt").write_text("not wanted")
    works = spark.createDataFrame([("W1",), ("W2",), ("W3",)], "work_id string")
    got = {r.work_id: r.fulltext for r in landing.local_fulltexts(spark, str(tmp_path), works).collect()}
    assert got == {"W1": "one two", "W2": "json body"}
    for folder in ("W2", "deep/er"):
        (tmp_path / folder).mkdir(parents=True)
    (tmp_path / "W2/W2.grobid-xml").write_bytes(b"<t>first <i>of all</i></t>")
    (tmp_path / "W3.tei.xml").write_bytes(b"<t>no layout of ours</t>")
    (tmp_path / "deep/er/W3.txt").write_text("neither place")
    got = {r.work_id: r.fulltext for r in landing.local_fulltexts(spark, str(tmp_path), works).collect()}
    assert got == {"W1": "one two", "W2": "first of all"}


def test_manifest_names_parts_by_the_end_of_their_path(spark, tmp_path):
    flat = tmp_path / "works"
    flat.mkdir()
    for i in range(3):
        (flat / f"part_000{i}.gz").write_bytes(gzip.compress(json.dumps(work(i, "t", 27)).encode()))
    named = lambda: sorted(r.relative for r in snapshot.part_files(spark, str(tmp_path), "works").collect())
    manifest = flat / "manifest"
    manifest.write_text(json.dumps({"files": [{"a": ["https://h.org/b/works/part%5F0000.gz?x=1"]}, {"note": "s3://x/part_0002.gz"}]}))
    assert named() == ["part_0000.gz", "part_0002.gz"]
    manifest.write_text(json.dumps(["s3://b/works/part_0009.gz"]))
    assert named() == ["part_0000.gz", "part_0001.gz", "part_0002.gz"]  # names none of ours
    manifest.write_text("not json")
    assert len(named()) == 3
    with pytest.raises(FileNotFoundError):
        snapshot.part_files(spark, str(tmp_path), "authors")


def test_ids_of_works_and_fields(spark):
    ids = ["https://x.org/W12/", "w7", "W", "https://x.org/w3", "", None]
    got = spark.createDataFrame([(i,) for i in ids], "v string").select(snapshot.work_id(F.col("v"))).collect()
    assert [r[0] for r in got] == ["W12", "W7", None, "W3", None, None]
    fields = ["https://x/fields/27/", "none", "https://x/topics/27", "27", "0", " fields/13 ", "", None, "https://x/fields/99999999999", "FIELDS/5"]
    got = spark.createDataFrame([(i,) for i in fields], "v string").select(snapshot.field_id(F.col("v"))).collect()
    assert [r[0] for r in got] == [27, None, None, 27, None, 13, None, None, None, 5]


def test_the_whole_record_of_a_work(spark, tmp_path):
    (tmp_path / "data/works").mkdir(parents=True)
    source = lambda i, name=None: {"source": {"id": i, "display_name": name, "type": "journal"}, "pdf_url": f"http://p/{i}" if i else ""}
    rows = [
        work(1, " A title ", 27, doi="10.1/x", language="en", type="article", primary_location=source("S1", "First"), locations=[source("S2"), source("S1", "again"), source(None, None), None], best_oa_location=source("S9"), content_urls={"pdf": "http://c", "xml": ""}, has_content={"pdf": False}, referenced_works=["W5"]),
        {"id": "https://x.org/W2/", "title": None, "display_name": "Other name", "publication_year": "2020", "abstract_inverted_index": {}, "topics": [{"field": 13}, {"field": True}, {"field": "https://x/fields/28"}, 7], "primary_topic": {"field": {"id": 13}}, "has_content": True},
        {"id": "W3", "publication_year": 1999, "abstract_inverted_index": {"a": [0, -1], "b": [0, 2]}, "topics": "none", "locations": None, "has_fulltext": False},
    ]
    (tmp_path / "data/works/part_0001.gz").write_bytes(gzip.compress("\n".join(map(json.dumps, rows)).encode()))
    got = {r.work_id: r for r in snapshot.works(snapshot.scan(spark, snapshot.part_files(spark, str(tmp_path), "works"))).collect()}
    a, b, c = got["W1"], got["W2"], got["W3"]
    assert (a.title, a.doi, a.language, a.type, a.year, a.full_id) == ("A title", "10.1/x", "en", "article", 2020, "https://x.org/W1")
    assert [s.id for s in a.sources] == ["S1", "S2"] and (a.primary_source_id, a.primary_source_name) == ("S1", "First")
    assert a.fulltext_urls == ["http://c", "http://p/S9", "http://p/S1", "http://p/S2"] and a.has_fulltext and a.references == ["W5"]
    assert (b.title, b.year, b.abstract, b.fields, b.has_fulltext, b.fulltext_urls) == ("Other name", 2020, None, [13, 28], True, [])
    assert (c.title, c.year, c.abstract, c.fields, c.sources, c.has_fulltext) == ("", 1999, "a b", [], [], False)
    assert json.loads(a.raw)["id"] == "https://x.org/W1"


def test_required_tables_and_scratch(spark, tmp_path):
    from lodestone import session

    spark.range(3).write.parquet(str(tmp_path / "orders.parquet"))
    session.require_tables(spark, str(tmp_path), ["orders"])
    with pytest.raises(FileNotFoundError, match="lacks customer, nation"):
        session.require_tables(spark, str(tmp_path), ["nation", "orders", "customer"])
    kept, gone = session.materialize(spark.range(5), "a"), session.materialize(spark.range(5), "b")
    session.discard(gone)
    assert kept.count() == 5
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        gone.count()


def test_command_line_lists_queries(capsys):
    from lodestone.__main__ import main

    assert main(["list"]) == 0 and "gold_facts" in capsys.readouterr().out.split()
