"""Media columns: ISO base media files as bytes, described by their boxes alone.

:func:`probe` walks nested boxes, decodes the sample tables of every track and reports codec,
timescale, duration, samples and the byte ranges of key frames; payloads are never decoded.
:func:`store_text` is the lossless writer behind the column: a text in UTF-8, padded with blanks to a
positive multiple of ``SAMPLE`` bytes, becomes one track of uncompressed 8x8 RGB samples, ``SAMPLE``
bytes each, dealt over chunks.  A null text is the empty text.  Equal texts give equal bytes.

A file that cannot be walked yields null features and an ``error`` in :func:`probe`.  Rows that repeat give
equal files; very long texts are stored whole, in memory of the order of the text; an empty table gives an
empty result.  Other columns stay; those named like a new column give way to it.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lodestone.llm.batches import with_columns

SAMPLE = 192
TIMESCALE = 25
KEY_EVERY = 12
CHUNK_SAMPLES = 16
#: Box types that hold boxes only.
CONTAINERS = frozenset("moov trak mdia minf stbl dinf edts udta mvex moof traf".split())


class MediaError(ValueError):
    pass


def box(kind: str, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind.encode("latin-1")) + body


def _full(kind: str, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *parts)


_MATRIX = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def pad(data: bytes, unit: int = SAMPLE) -> bytes:
    """Blanks up to a positive multiple of ``unit``."""
    return data + b" " * (-len(data) % unit or (0 if data else unit))


def write_media(payload: bytes) -> bytes:
    """A media file whose samples are the payload, ``SAMPLE`` bytes each."""
    n = len(payload) // SAMPLE
    if not n or len(payload) % SAMPLE:
        raise MediaError("the payload is not a positive multiple of a sample")
    chunks = -(-n // CHUNK_SAMPLES)
    last = n - (chunks - 1) * CHUNK_SAMPLES
    runs = [(1, CHUNK_SAMPLES, 1)] * (chunks > 1) + ([(chunks, last, 1)] if chunks == 1 or last != CHUNK_SAMPLES else [])
    keys = np.arange(1, n + 1, KEY_EVERY, dtype=">u4")
    entry = box("raw ", bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HHIIIH", 8, 8, 0x480000, 0x480000, 0, 1), bytes(32), struct.pack(">Hh", 24, -1))
    front = box("ftyp", b"isom", struct.pack(">I", 512), b"isomiso2")

    def movie(first: int) -> bytes:
        offsets = first + np.arange(chunks, dtype=np.uint64) * (CHUNK_SAMPLES * SAMPLE)
        wide = int(offsets[-1]) >= 1 << 32
        table = _full("co64" if wide else "stco", struct.pack(">I", chunks), offsets.astype(">u8" if wide else ">u4").tobytes())
        tables = box(
            "stbl",
            _full("stsd", struct.pack(">I", 1), entry),
            _full("stts", struct.pack(">III", 1, n, 1)),
            _full("stss", struct.pack(">I", len(keys)), keys.tobytes()),
            _full("stsc", struct.pack(">I", len(runs)), *[struct.pack(">III", *r) for r in runs]),
            _full("stsz", struct.pack(">II", SAMPLE, n)),
            table,
        )
        info = box("minf", _full("vmhd", bytes(8), flags=1), box("dinf", _full("dref", struct.pack(">I", 1), _full("url ", flags=1))), tables)
        media = box("mdia", _full("mdhd", struct.pack(">IIIIHH", 0, 0, TIMESCALE, n, 0x55C4, 0)), _full("hdlr", struct.pack(">I4s", 0, b"vide"), bytes(12), b"payload\0"), info)
        head = _full("tkhd", struct.pack(">IIIII", 0, 0, 1, 0, n), bytes(8), struct.pack(">hhhH", 0, 0, 0, 0), _MATRIX, struct.pack(">II", 8 << 16, 8 << 16), flags=3)
        return box("moov", _full("mvhd", struct.pack(">IIIIIH", 0, 0, TIMESCALE, n, 0x10000, 0x100), bytes(10), _MATRIX, bytes(24), struct.pack(">I", 2)), box("trak", head, media))

    size = len(movie(0))
    return b"".join([front, movie(len(front) + size + 8), struct.pack(">I4s", 8 + len(payload), b"mdat"), payload])


def walk(data: memoryview, begin: int = 0, end: int | None = None, path: str = "") -> Iterator[tuple[str, int, int]]:
    """``(path, body begin, body end)`` of every box, parents before children."""
    end = len(data) if end is None else end
    at = begin
    while at < end:
        if end - at < 8:
            raise MediaError(f"{end - at} stray bytes at {at}")
        size, kind = struct.unpack_from(">I4s", data, at)
        body = at + 8
        if size == 1:
            if end - at < 16:
                raise MediaError(f"the large size at {at} is cut")
            (size,) = struct.unpack_from(">Q", data, body)
            body += 8
        elif size == 0:
            size = end - at
        if size < body - at or at + size > end:
            raise MediaError(f"box {kind!r} at {at} claims {size} bytes")
        name = f"{path}/{kind.decode('latin-1')}"
        yield name, body, at + size
        if kind.decode("latin-1") in CONTAINERS:
            if name.count("/") > 32:
                raise MediaError("boxes are nested too deeply")
            yield from walk(data, body, at + size, name)
        at += size


@dataclass
class Track:
    handler: str = ""
    codec: str = ""
    timescale: int = 0
    duration: int = 0
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    offsets: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def key_ranges(self) -> list[tuple[int, int]]:
        return list(zip(self.offsets[self.keys].tolist(), self.sizes[self.keys].tolist()))


def _table(data: memoryview, begin: int, end: int, columns: int, kind: str = ">u4") -> np.ndarray:
    (n,) = struct.unpack_from(">I", data, begin + 4)
    width = columns * int(kind[-1])
    if n * width > end - begin - 8:
        raise MediaError(f"a table of {n} entries is cut")
    return np.frombuffer(data, kind, n * columns, begin + 8).astype(np.int64).reshape(n, columns)


def _header(data: memoryview, begin: int) -> tuple[int, int]:
    """Timescale and duration of a media or movie header."""
    return struct.unpack_from(">IQ", data, begin + 20) if data[begin] == 1 else struct.unpack_from(">II", data, begin + 12)


def _finish(raw: dict[str, np.ndarray], track: Track, total: int) -> Track:
    n = len(track.sizes)
    chunks, runs = raw.get("chunks"), raw.get("runs")
    if n and (chunks is None or runs is None or not len(runs)):
        raise MediaError("a track has samples but no chunks")
    if n:
        if runs[0, 0] != 1 or (np.diff(runs[:, 0]) <= 0).any() or runs[-1, 0] > len(chunks):
            raise MediaError("the chunk runs are out of order")
        per_chunk = np.repeat(runs[:, 1], np.diff(np.append(runs[:, 0], len(chunks) + 1)))
        if per_chunk.sum() != n:
            raise MediaError(f"chunks hold {per_chunk.sum()} samples, the size table {n}")
        ends = np.cumsum(track.sizes)
        starts = ends - track.sizes
        first = np.cumsum(per_chunk) - per_chunk
        base = np.zeros(len(per_chunk), np.int64)
        base[per_chunk > 0] = starts[first[per_chunk > 0]]
        track.offsets = np.repeat(chunks, per_chunk) + starts - np.repeat(base, per_chunk)
        if (track.offsets < 0).any() or (track.offsets + track.sizes > total).any():
            raise MediaError("a sample lies outside the file")
        if "times" in raw and raw["times"][:, 0].sum() != n:
            raise MediaError("the time table has another sample count")
    keys = raw.get("keys")
    track.keys = np.arange(n) if keys is None else keys - 1
    if len(track.keys) and (track.keys.min() < 0 or track.keys.max() >= n):
        raise MediaError("a key frame is no sample")
    if "times" in raw and not track.duration:
        track.duration = int((raw["times"][:, 0] * raw["times"][:, 1]).sum())
    return track


def parse(content: bytes) -> list[Track]:
    """All tracks of a file, from its boxes and sample tables."""
    data = memoryview(content)
    tracks: list[tuple[Track, dict]] = []
    try:
        for path, begin, end in walk(data):
            name = path.rsplit("/", 1)[1]
            if path == "/moov/trak":
                tracks.append((Track(), {}))
            if not path.startswith("/moov/trak/") or not tracks:
                continue
            track, raw = tracks[-1]
            if name == "mdhd":
                track.timescale, track.duration = _header(data, begin)
            elif name == "hdlr":
                track.handler = bytes(data[begin + 8 : begin + 12]).decode("latin-1")
            elif name == "stsd":
                track.codec = bytes(data[begin + 12 : begin + 16]).decode("latin-1").strip()
            elif name == "stts":
                raw["times"] = _table(data, begin, end, 2)
            elif name == "stss":
                raw["keys"] = _table(data, begin, end, 1)[:, 0]
            elif name == "stsc":
                raw["runs"] = _table(data, begin, end, 3)
            elif name in ("stco", "co64"):
                raw["chunks"] = _table(data, begin, end, 1, ">u8" if name == "co64" else ">u4")[:, 0]
            elif name == "stsz":
                fixed, n = struct.unpack_from(">II", data, begin + 4)
                if fixed and n > len(data):
                    raise MediaError("more samples than bytes")
                track.sizes = np.full(n, fixed, np.int64) if fixed else _table(data, begin + 4, end, 1)[:, 0]
        return [_finish(raw, track, len(content)) for track, raw in tracks]
    except struct.error as e:
        raise MediaError(str(e)) from None


def samples(content: bytes, track: Track) -> bytes:
    """The bytes of all samples in order, neighbouring ranges read at once."""
    if not len(track.sizes):
        return b""
    ends = track.offsets + track.sizes
    cut = np.flatnonzero(track.offsets[1:] != ends[:-1]) + 1
    first, last = np.append(0, cut), np.append(cut, len(ends)) - 1
    return b"".join([content[a:b] for a, b in zip(track.offsets[first].tolist(), ends[last].tolist())])


_RANGE = T.ArrayType(T.StructType([T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())]))
_PROBE = T.StructType(
    [
        T.StructField("codec", T.StringType()),
        T.StructField("timescale", T.LongType()),
        T.StructField("duration", T.LongType()),
        T.StructField("n_samples", T.LongType()),
        T.StructField("key_ranges", _RANGE),
        T.StructField("error", T.StringType()),
    ]
)
_READ = T.StructType(
    [
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_sha256", T.StringType()),
        T.StructField("tail_crc32", T.LongType()),
        T.StructField("media_bytes", T.LongType()),
        T.StructField("media_sha256", T.StringType()),
        T.StructField("feature", T.StringType()),
    ]
)


def store_text(docs: DataFrame, text_col: str = "text", media_col: str = "media", drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs``, less the columns ``drop``, with each whole text as a media file in ``media_col`` and its own length in ``n_bytes``."""

    def start():
        def compute(texts):
            raw = [(t or "").encode() for t in texts.to_pylist()]
            return [[write_media(pad(x)) for x in raw], [len(x) for x in raw]]

        return compute

    return with_columns(docs, [text_col], T.StructType([T.StructField(media_col, T.BinaryType()), T.StructField("n_bytes", T.LongType())]), start, drop)


def probe(df: DataFrame, media_col: str = "media") -> DataFrame:
    """``df`` with codec, timescale, duration, sample count and key-frame ranges of the first track."""

    def one(content: bytes | None):
        if content is None:
            return None, None, None, None, None, None
        try:
            tracks = parse(content)
            if not tracks:
                raise MediaError("no track")
            t = tracks[0]
            return t.codec, t.timescale, t.duration, len(t.sizes), [{"offset": a, "length": b} for a, b in t.key_ranges()], None
        except MediaError as e:
            return None, None, None, None, None, str(e)

    def start():
        def compute(media):
            made = [one(x) for x in media.to_pylist()]
            return [list(c) for c in zip(*made)] if made else [[] for _ in _PROBE]

        return compute

    return with_columns(df, [media_col], _PROBE, start)


def feature_of(track: Track) -> str:
    keys = track.key_ranges()
    spelled = ",".join(f"{a}+{b}" for a, b in keys)
    return f"codec={track.codec};timescale={track.timescale};duration={track.duration};samples={len(track.sizes)};keys={len(keys)};ranges={spelled}"


def read_back(df: DataFrame, media_col: str = "media") -> DataFrame:
    """``df`` without its media, with digests of the stored file and of the samples that its tables point to."""

    def one(content: bytes):
        track = parse(content)[0]
        payload = samples(content, track)
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(content), hashlib.sha256(content).hexdigest(), feature_of(track)

    def start():
        def compute(media):
            made = [one(x) for x in media.to_pylist()]
            return [list(c) for c in zip(*made)] if made else [[] for _ in _READ]

        return compute

    return with_columns(df, [media_col], _READ, start, (media_col,))
