"""WARC archives in Zstandard: one frame per record behind a dictionary in a leading skippable frame.

Writer: every task writes its own archives below a shared folder, under names that no other attempt
uses, and reports them in a manifest; only archives of successful tasks are ever read.  All archives
carry one dictionary, trained once on a bounded sample of the pages.  Reader: loads the dictionary,
decodes one frame at a time, and checks each record's version, field syntax, mandatory fields, lengths
and digests.  A damaged archive yields its sound records and then one row whose ``error`` says what
failed at which offset.  Memory on both sides is that of one record and a batch, whatever an archive
holds; a record itself is held whole, since its digest and length are checked before it is returned.

Pages: of equal payloads of at least ``min_bytes`` bytes the one with the smallest page id becomes a
response record and the others revisit it; smaller payloads are all responses.  A null html is the
empty payload, a null url becomes ``urn:page:``.  Rows that repeat both id and payload count as that
one page, so all of them get its type.  A null id sorts after all others and is no equal of any string.
Ids may be of any type that casts to and from a string.  An empty table gives no archive and no row.
Other columns of the pages are not archived, so their names cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.skew import salted_join
from lodestone.session import materialize, scratch_path

DICTIONARY_MAGIC = 0x184D2A5D
_SKIPPABLE = range(0x184D2A50, 0x184D2A60)
_FRAME_MAGIC = 0xFD2FB528
_READ = 1 << 15
MANDATORY = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


class ArchiveError(ValueError):
    pass


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@dataclass
class Record:
    offset: int
    fields: dict[str, str]
    block: bytes = field(repr=False)

    @property
    def payload(self) -> bytes:
        """The block without its HTTP head, for records that have one."""
        if self.fields.get("Content-Type", "").startswith("application/http"):
            return self.block.partition(b"\r\n\r\n")[2]
        return self.block


def build_record(fields: dict[str, str], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in fields.items()] + [f"WARC-Block-Digest: sha1:{sha1_base32(block)}", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse_record(data: bytes, offset: int = 0) -> Record:
    """Validates one decoded record: header syntax, mandatory fields, lengths and digests."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap:
        raise ArchiveError("the header does not end")
    try:
        lines = head.decode().split("\r\n")
    except UnicodeDecodeError:
        raise ArchiveError("the header is not UTF-8") from None
    if lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ArchiveError(f"unknown version {lines[0][:20]!r}")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ArchiveError(f"malformed field {line[:40]!r}")
        fields[name] = value.strip()
    for name in MANDATORY:
        if not fields.get(name):
            raise ArchiveError(f"{name} is missing")
    if not (fields["Content-Length"].isascii() and fields["Content-Length"].isdigit()):
        raise ArchiveError("Content-Length is not a number")
    length = int(fields["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ArchiveError(f"Content-Length is {length}, the frame holds {len(rest) - 4}")
    record = Record(offset, fields, rest[:length])
    for name, body in (("WARC-Block-Digest", record.block), ("WARC-Payload-Digest", record.payload)):
        if name in fields and not (name == "WARC-Payload-Digest" and fields["WARC-Type"] == "revisit"):
            if fields[name] != f"sha1:{sha1_base32(body)}":
                raise ArchiveError(f"{name} does not match")
    return record


def iter_records(stream) -> Iterator[Record]:
    """Records of one archive, a frame at a time; raises :class:`ArchiveError` at the first fault."""
    import zstandard

    held, offset, dictionary, maker, first = b"", 0, None, None, True

    def fill(n: int) -> None:
        nonlocal held
        while len(held) < n and (more := stream.read(max(_READ, n - len(held)))):
            held += more

    while True:
        fill(8)
        if not held:
            return
        if len(held) < 8:
            raise ArchiveError(f"offset {offset}: {len(held)} stray bytes")
        magic = int.from_bytes(held[:4], "little")
        if magic in _SKIPPABLE:
            size = int.from_bytes(held[4:8], "little")
            fill(8 + size)
            if len(held) < 8 + size:
                raise ArchiveError(f"offset {offset}: the skippable frame is cut")
            if first and magic == DICTIONARY_MAGIC:
                body = held[8 : 8 + size]
                if body[:4] == _FRAME_MAGIC.to_bytes(4, "little"):
                    body = zstandard.ZstdDecompressor().decompress(body, max_output_size=1 << 27)
                dictionary = zstandard.ZstdCompressionDict(body)
            held, offset, first = held[8 + size :], offset + 8 + size, False
            continue
        if magic != _FRAME_MAGIC:
            raise ArchiveError(f"offset {offset}: no frame begins here")
        if maker is None:
            maker = zstandard.ZstdDecompressor(dict_data=dictionary)
        decoder, first = maker.decompressobj(), False
        parts, used, chunk = [], 0, held
        try:
            while True:
                parts.append(decoder.decompress(chunk))
                used += len(chunk)
                if decoder.eof:
                    break
                chunk = stream.read(_READ)
                if not chunk:
                    raise ArchiveError(f"offset {offset}: the frame is cut")
        except zstandard.ZstdError as e:
            raise ArchiveError(f"offset {offset}: {e}") from None
        held = decoder.unused_data
        try:
            yield parse_record(b"".join(parts), offset)
        except ArchiveError as e:
            raise ArchiveError(f"offset {offset}: {e}") from None
        offset += used - len(held)


def train_dictionary(samples: list[bytes], size: int = 1 << 14) -> bytes:
    """A dictionary of at most ``size`` bytes; of too few samples to train on, their own last bytes."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


class ArchiveWriter:
    """Writes records into one archive, behind ``dictionary`` or one trained on the first records."""

    def __init__(self, out, dictionary: bytes | None = None, sample_bytes: int = 1 << 21, dictionary_bytes: int = 1 << 14):
        self.out, self.sample_bytes, self.dictionary_bytes = out, sample_bytes, dictionary_bytes
        self.early: list[bytes] = []
        self.early_bytes = self.written = self.records = 0
        self.coder = None
        if dictionary is not None:
            self._begin(dictionary)

    def _begin(self, body: bytes) -> None:
        import zstandard

        self._put(DICTIONARY_MAGIC.to_bytes(4, "little") + len(body).to_bytes(4, "little") + body)
        self.coder = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(body), write_checksum=True)
        for data in self.early:
            self._put(self.coder.compress(data))
        self.early = []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.written += len(data)

    def add(self, data: bytes) -> None:
        self.records += 1
        if self.coder is None:
            self.early.append(data)
            self.early_bytes += len(data)
            if self.early_bytes >= self.sample_bytes:
                self._begin(train_dictionary(self.early, self.dictionary_bytes))
        else:
            self._put(self.coder.compress(data))

    def close(self) -> None:
        if self.coder is None:
            self._begin(train_dictionary(self.early, self.dictionary_bytes))
        self.out.close()


def _record_id(page_id) -> str:
    name = "page" if page_id is None else f"page {page_id}"
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(name.encode()).digest())}>"


def _spelled(page_id) -> str:
    """An id as a header value; the reader undoes the quoting."""
    from urllib.parse import quote

    return "" if page_id is None else quote(str(page_id), safe="")


def page_record(page_id, url: str | None, payload: bytes, refers_to, is_revisit: bool, date: str) -> bytes:
    uri = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url) if url else f"urn:page:{_spelled(page_id)}"
    fields = {
        "WARC-Type": "revisit" if is_revisit else "response",
        "WARC-Record-ID": _record_id(page_id),
        "WARC-Date": date,
        "WARC-Target-URI": uri,
        "WARC-Payload-Digest": f"sha1:{sha1_base32(payload)}",
        "Content-Type": "application/http;msgtype=response",
        "X-Payload-Length": str(len(payload)),
    }
    if page_id is not None:
        fields["X-Page-ID"] = _spelled(page_id)
    if is_revisit:
        fields |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": _record_id(refers_to), "X-Refers-To-Page-ID": _spelled(refers_to)}
    return build_record(fields, _HTTP % len(payload) + (b"" if is_revisit else payload))


def digests(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``(page, payload_sha1, n)`` of every row."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    return pages.select(F.col(id_col).alias("page"), F.sha1(payload).alias("payload_sha1"), F.octet_length(payload).alias("n"))


def decide_revisits(thin: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``(page_key, payload_sha1, refers_to)`` of the pages that revisit another, out of ``digests``."""
    known = thin.filter(F.col("n") >= min_bytes).groupBy("page", "payload_sha1").agg(F.count("*").alias("rows"))
    least = known.groupBy("payload_sha1").agg(F.min("page").alias("refers_to"), F.count("*").alias("pages")).filter("pages > 1").drop("pages")
    # One payload may hold a third of all pages.
    met = salted_join(known, least, ["payload_sha1"], F.xxhash64("page"))
    return met.filter(~F.col("page").eqNullSafe(F.col("refers_to"))).select(_key("page").alias("page_key"), "payload_sha1", "refers_to")


def _key(column: str):
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("-"))


def sample_records(pages: DataFrame, date: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rows: int = 256, most: int = 1 << 13) -> list[bytes]:
    """Records of about ``rows`` pages drawn at random, each payload cut to ``most`` bytes: what the dictionary is trained on.

    Twice as many are drawn at their expected rate, so what reaches the driver is bounded (4 MB) at every
    size.  The sample changes no result; records are archived whole.
    """
    body = F.substring(F.coalesce(F.col(html_col), F.lit("")).cast("binary"), 1, most)
    drawn = pages.select(F.rand(11).alias("h"), F.col(id_col).alias("page"), F.substring(url_col, 1, 200).alias("url"), body.alias("body"))
    drawn = drawn.filter(F.col("h") < 2.0 * rows / max(1, pages.count()))
    return [page_record(r.page, r.url, bytes(r.body), None, False, date) for r in drawn.orderBy("h").limit(rows).collect()]


def write_pages(
    pages: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = 0,
    archive_bytes: int = 1 << 25,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Writes the archives and returns their manifest ``(path, records, bytes)``, itself a table."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    dictionary = train_dictionary(sample_records(pages, date, id_col, url_col, html_col))
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), payload.alias("payload"), _key(id_col).alias("page_key"), F.sha1(payload).alias("payload_sha1"))
    # Pages are the wide side, so the decisions are hashed and no page is sorted.  Rows that repeat a page
    # are dealt by the task that scans them.
    rows = salted_join(rows, decide_revisits(digests(pages, id_col, html_col), min_bytes).withColumn("again", F.lit(True)), ["page_key", "payload_sha1"], F.spark_partition_id(), "left", 8, "shuffle_hash")
    rows = rows.select("page", "url", "payload", "refers_to", F.coalesce("again", F.lit(False)).alias("again"))

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        own = f"{root}/{uuid.uuid4().hex}"
        done, writer, path = [], None, ""
        for batch in batches:
            for page, url, body, refers, again in zip(*(batch.column(i) for i in range(5))):
                if writer is None:
                    store.create_dir(own, recursive=True)
                    path = f"{own}/part-{len(done):05d}.warc.zst"
                    writer = ArchiveWriter(store.open_output_stream(path, compression=None), dictionary)
                    writer.add(build_record({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": date, "Content-Type": "application/warc-fields"}, b"format: WARC file version 1.1\r\n"))
                writer.add(page_record(page.as_py(), url.as_py(), body.as_py(), refers.as_py(), again.as_py(), date))
                if writer.written >= archive_bytes:
                    writer.close()
                    done.append((path, writer.records, writer.written))
                    writer = None
        if writer is not None:
            writer.close()
            done.append((path, writer.records, writer.written))
        if done:
            scheme = folder.partition(root)[0] if root in folder else "file://"
            yield pa.RecordBatch.from_arrays([pa.array([f"{scheme}{p}" for p, _, _ in done]), pa.array([n for _, n, _ in done], pa.int64()), pa.array([b for _, _, b in done], pa.int64())], names=["path", "records", "bytes"])

    return materialize(rows.mapInArrow(run, "path string, records bigint, bytes bigint"), "warc-manifest")


RECORD_SCHEMA = "path string, offset bigint, record_type string, record_id string, target_uri string, fields map<string,string>, payload_bytes bigint, payload_digest string, payload binary, error string"


def _rows(path: str, stream, with_payload: bool):
    try:
        for r in iter_records(stream):
            payload, f = r.payload, r.fields
            if f["WARC-Type"] == "revisit":
                length, digest = int(f.get("X-Payload-Length", len(payload))), f.get("WARC-Payload-Digest", "").removeprefix("sha1:")
            else:
                length, digest = len(payload), sha1_base32(payload)
            yield path, r.offset, f["WARC-Type"], f["WARC-Record-ID"], f.get("WARC-Target-URI"), list(f.items()), length, digest, payload if with_payload else None, None
    except ArchiveError as e:
        yield path, None, None, None, None, [], None, None, None, str(e)


def _batches(rows, most_rows: int = 2000, most_bytes: int = 1 << 25):
    import pyarrow as pa

    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.int64(), pa.string(), pa.binary(), pa.string()]
    names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[8] or b"")
        if len(held) >= most_rows or size >= most_bytes:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


def read_manifest(manifest: DataFrame, with_payload: bool = True, tasks: int | None = None) -> DataFrame:
    """Records of the archives listed in ``path``, streamed from the shared store."""

    def run(batches):
        from pyarrow import fs

        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_stream(name, compression=None) as stream:
                    yield from _batches(_rows(path, stream, with_payload))

    spread = manifest.select("path").repartition(tasks or manifest.sparkSession.sparkContext.defaultParallelism * 2, "path")
    return spread.mapInArrow(run, RECORD_SCHEMA)


def read_warc(spark, paths, with_payload: bool = True) -> DataFrame:
    """Records of archives below any Hadoop path or glob, streamed by the tasks.

    Spark lists the files; a file system that only Spark can open has its archives loaded whole, up to the
    2 GB of a binary column.
    """
    import re

    files = spark.read.format("binaryFile").load(paths)
    first = files.select("path").first()
    if first is None:
        return spark.createDataFrame([], RECORD_SCHEMA)
    if re.match(r"(file|hdfs|s3a?|gs|abfss?):", first.path):
        named = F.regexp_replace(F.regexp_replace("path", "^file:/+", "file:///"), "^s3a:", "s3:")
        return read_manifest(files.select(named.alias("path")), with_payload)

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                yield from _batches(_rows(path.as_py(), io.BytesIO(content.as_py()), with_payload))

    return files.select("path", "content").mapInArrow(run, RECORD_SCHEMA)


def page_records(records: DataFrame, id_type: str = "bigint") -> DataFrame:
    """One row per page record, as read back; ids are cast to ``id_type``."""
    f = F.col("fields")
    id_of = lambda name: F.url_decode(f[name]).cast(id_type)
    fault = F.raise_error(F.concat(F.lit("damaged archive "), F.col("path"), F.lit(": "), F.col("error")))
    return records.filter(F.col("error").isNotNull() | F.col("record_type").isin("response", "revisit")).select(
        F.when(F.col("error").isNotNull(), fault.cast(id_type)).otherwise(id_of("X-Page-ID")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        id_of("X-Refers-To-Page-ID").alias("refers_to"),
    )


def archive_round_trip(pages: DataFrame, **writing) -> DataFrame:
    """Writes a record per page and returns what the archives say of each page."""
    id_type = pages.schema[writing.get("id_col", "page_id")].dataType.simpleString()
    return page_records(read_manifest(write_pages(pages, **writing), with_payload=False), id_type)


_NIBBLES = "['" + "', '".join(f"{i:04b}" for i in range(16)) + "']"
OP1_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, octet_length(body) AS n, sha1(body) AS digest FROM p),
b AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: {_NIBBLES}[instr('0123456789abcdef', substr(digest, i, 1))]), '') AS bits,
             min(page_id) OVER (PARTITION BY digest) AS root FROM h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + 16 * CAST(substr(bits, 5 * j + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * j + 2, 1) AS INT) + 4 * CAST(substr(bits, 5 * j + 3, 1) AS INT)
           + 2 * CAST(substr(bits, 5 * j + 4, 1) AS INT) + CAST(substr(bits, 5 * j + 5, 1) AS INT), 1)), '') AS payload_digest,
       CASE WHEN root = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN root <> page_id THEN root END AS refers_to
FROM b
"""
