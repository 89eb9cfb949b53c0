import base64
import hashlib
import io
import random

import pytest
import zstandard

from lodestone.llm import warc


class Sink(io.BytesIO):
    def close(self):
        self.data = self.getvalue()


def archive(payloads, **kw):
    sink = Sink()
    w = warc.ArchiveWriter(sink, **kw)
    for i, p in enumerate(payloads):
        w.add(warc.page_record(i, f"http://x/{i}", p, None, False, "2024-01-01T00:00:00Z"))
    w.close()
    return sink.data


def payloads(n=60):
    rng = random.Random(1)
    return [("<html>" + " ".join(rng.choice("alpha beta gamma delta".split()) for _ in range(rng.randint(0, 300)))).encode() for _ in range(n)]


def test_dictionary_leads_and_every_record_has_its_frame():
    body = payloads()
    data = archive(body, sample_bytes=5000, dictionary_bytes=1024)
    assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_MAGIC
    records = list(warc.iter_records(io.BytesIO(data)))
    assert [r.payload for r in records] == body
    size = int.from_bytes(data[4:8], "little")
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    for a, b in zip(records, [*records[1:], None]):
        frame = data[a.offset : b.offset if b else len(data)]
        one = decoder.decompressobj()
        assert one.decompress(frame).startswith(b"WARC/1.1\r\n") and one.eof and not one.unused_data


def test_compressed_dictionary_is_accepted():
    data = archive(payloads(), sample_bytes=5000, dictionary_bytes=1024)
    size = int.from_bytes(data[4:8], "little")
    packed = zstandard.ZstdCompressor().compress(data[8 : 8 + size])
    again = data[:4] + len(packed).to_bytes(4, "little") + packed + data[8 + size :]
    assert [r.payload for r in warc.iter_records(io.BytesIO(again))] == payloads()


@pytest.mark.parametrize("cut", [1, 5, 100, -1, -9])
def test_cut_archives_keep_sound_records(cut):
    data = archive(payloads(), sample_bytes=5000)
    rows = list(warc._rows("p", io.BytesIO(data[: len(data) + cut] if cut < 0 else data[:cut]), True))
    assert rows[-1][-1] and all(r[-1] is None for r in rows[:-1])
    assert len(rows) == (60 if cut < 0 else 1)


def test_faults_are_named():
    ok = warc.build_record({"WARC-Type": "resource", "WARC-Record-ID": "<urn:a>", "WARC-Date": "2024-01-01T00:00:00Z"}, b"body")
    assert warc.parse_record(ok).payload == b"body"
    for bad, what in [
        (ok.replace(b"WARC/1.1", b"WARC/9.9"), "version"),
        (ok.replace(b"Content-Length: 4", b"Content-Length: 5"), "Content-Length"),
        (ok.replace(b"Content-Length: 4", b"Content-Length: x"), "not a number"),
        (ok.replace(b"WARC-Date: 2024-01-01T00:00:00Z", b"WARC-Date: "), "WARC-Date is missing"),
        (ok.replace(b"WARC-Type: resource", b"WARC-Type resource"), "malformed"),
        (ok.replace(b"body", b"bodY"), "WARC-Block-Digest"),
        (ok[:-2], "Content-Length"),
        (b"WARC/1.1\r\n", "does not end"),
    ]:
        with pytest.raises(warc.ArchiveError, match=what):
            warc.parse_record(bad)


def expected(rows, min_bytes=0):
    least = {}
    for p, _, html in rows:
        body = (html or "").encode()
        if p is not None and len(body) >= min_bytes:
            least[body] = min(p, least.get(body, p))
    out = []
    for p, _, html in rows:
        body = (html or "").encode()
        root = least.get(body, p) if len(body) >= min_bytes else p
        again = root != p
        out.append((p, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", root if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 4])
def test_round_trip_matches_brute_force(spark, min_bytes):
    rng = random.Random(4)
    rows = [(i, f"http://h/{i}" if i % 3 else None, rng.choice(["", None, "a", "abcd", "ünï" * i, "hot page " * 50])) for i in range(200)]
    rows += [(5, "http://again\r\n/x", "abcd"), (7, "u", "own"), (7, "u", "own"), (None, "u", "abcd"), (None, None, "only here")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    got = warc.archive_round_trip(df, min_bytes=min_bytes, archive_bytes=2000).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows, min_bytes)
    assert warc.archive_round_trip(df.limit(0)).collect() == []


def test_spark_reads_archives_by_path(spark, tmp_path):
    (tmp_path / "a.warc.zst").write_bytes(archive(payloads()))
    (tmp_path / "b.warc.zst").write_bytes(archive(payloads())[:-3])
    out = warc.read_warc(spark, str(tmp_path)).collect()
    assert sum(r.error is None for r in out) == 119 and sum(r.error is not None for r in out) == 1


def test_written_archives_are_plain(spark, tmp_path):
    """The files hold the frames themselves: a dictionary frame first, then records that any reader can walk."""
    rows = [(i, f"http://h/{i}", f"page {i} " * 20) for i in range(40)]
    manifest = warc.write_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), folder=f"file://{tmp_path}/out").collect()
    seen = []
    for m in manifest:
        with open(m.path.removeprefix("file://"), "rb") as f:
            data = f.read()
        assert len(data) == m.bytes and int.from_bytes(data[:4], "little") == warc.DICTIONARY_MAGIC
        records = list(warc.iter_records(io.BytesIO(data)))
        assert len(records) == m.records
        seen += [r.payload.decode() for r in records[1:]]
    assert sorted(seen) == sorted(h for _, _, h in rows)
    assert sum(r.error is None for r in warc.read_warc(spark, f"file://{tmp_path}/out/*").collect()) == 40 + len(manifest)


def test_ids_of_any_type(spark):
    rows = [("b", "u", "same"), ("-", "u", "same"), (None, "u", "same"), ("a+b %/é", "u", "own"), ("=", None, None)]
    out = {r.page_id: r for r in warc.archive_round_trip(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()}
    assert set(out) == {r[0] for r in rows}
    assert out["-"].record_type == "response"
    assert {k for k, r in out.items() if r.refers_to == "-"} == {"b", None}
    assert out["a+b %/é"].record_type == "response" and out["="].payload_bytes == 0


def test_one_payload_and_one_page_may_be_hot(spark):
    """A third of all rows share a payload, a third are one page; salts keep them whole."""
    rows = [(i, "u", "hot") for i in range(300)] + [(7000, "v", "page")] * 300 + [(8000 + i, "w", f"own {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    assert sorted((tuple(r) for r in warc.archive_round_trip(df).collect()), key=str) == expected(rows)
