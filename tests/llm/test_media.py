import hashlib
import struct
import zlib

import pytest

from lodestone.llm import media


@pytest.mark.parametrize("n", [0, 1, 191, 192, 193, 192 * 16, 192 * 16 + 1, 192 * 48, 300_000])
def test_round_trip(n):
    payload = media.pad((bytes(range(256)) * (n // 256 + 1))[:n])
    assert payload and len(payload) % 192 == 0 and payload[:n] + b" " * (len(payload) - n) == payload
    content = media.write_media(payload)
    (track,) = media.parse(content)
    assert media.samples(content, track) == payload
    assert (track.codec, track.handler, track.timescale, track.duration) == ("raw", "vide", 25, len(payload) // 192)
    assert [content[a : a + b] for a, b in track.key_ranges()] == [payload[i : i + 192] for i in range(0, len(payload), 192 * media.KEY_EVERY)]


def foreign(keys=True, wide=False, version=0):
    """A hand-made file: an audio track with sample sizes of its own, chunks in reverse order, media data first."""
    data = b"AAAABBBBBCCCCCCDDDDDDD"
    head = media.box("free", b"xx") + struct.pack(">I4sQ", 1, b"mdat", 16 + len(data)) + data
    base = len(head) - len(data)
    times = struct.pack(">IIII", 3, 10, 1, 7)
    header = struct.pack(">QQIQHH", 0, 0, 8000, 37, 0, 0) if version else struct.pack(">IIIIHH", 0, 0, 8000, 37, 0, 0)
    offsets = [base + 9, base]  # chunk 1 holds C and D, chunk 2 holds A and B
    table = media.box("co64", struct.pack(">IIQQ", 0, 2, *offsets)) if wide else media.box("stco", struct.pack(">IIII", 0, 2, *offsets))
    tables = [
        media.box("stsd", struct.pack(">II", 0, 1), media.box("mp4a", bytes(28))),
        media.box("stts", struct.pack(">II", 0, 2), times),
        media.box("stsc", struct.pack(">IIIII", 0, 1, 1, 2, 1)),
        media.box("stsz", struct.pack(">III", 0, 0, 4), struct.pack(">IIII", 6, 7, 4, 5)),
        table,
    ]
    if keys:
        tables.append(media.box("stss", struct.pack(">IIII", 0, 2, 1, 3)))
    body = media.box("mdia", media.box("mdhd", struct.pack(">I", version << 24), header), media.box("minf", media.box("stbl", *tables)))
    return head + media.box("moov", media.box("trak", body))


@pytest.mark.parametrize("wide,version", [(False, 0), (True, 1)])
def test_foreign_layouts(wide, version):
    content = foreign(wide=wide, version=version)
    (track,) = media.parse(content)
    assert media.samples(content, track) == b"CCCCCCDDDDDDDAAAABBBBB"
    assert (track.codec, track.timescale, track.duration) == ("mp4a", 8000, 37)
    assert [content[a : a + b] for a, b in track.key_ranges()] == [b"CCCCCC", b"AAAA"]
    assert len(media.parse(foreign(keys=False))[0].key_ranges()) == 4


def test_damage_is_named():
    good = media.write_media(media.pad(b"x" * 5000))
    for n in range(1, len(good), 7):
        try:
            media.parse(good[:n])
        except media.MediaError:
            pass
    for bad in (b"\0\0\0\4ftyp", b"\0\0", good.replace(b"stsc", b"stsd"), good[:-200]):
        with pytest.raises(media.MediaError):
            media.parse(bad)


def test_columns(spark):
    rows = [(1, "héllo", "m"), (2, None, "m"), (3, "", "m"), (1, "héllo", None), (4, "long " * 9000, "m")]
    df = spark.createDataFrame(rows, "doc_id long, text string, media string")
    stored = media.store_text(df.select("doc_id", "text"))
    out = media.read_back(stored).collect()
    for r, (i, text, _) in zip(out, rows):
        raw = (text or "").encode()
        payload = media.pad(raw)
        assert (r.doc_id, r.n_bytes, r.payload_bytes) == (i, len(raw), len(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-16:])
        content = media.write_media(payload)
        assert (r.media_bytes, r.media_sha256) == (len(content), hashlib.sha256(content).hexdigest())
    assert media.read_back(stored.limit(0)).collect() == []
    odd = spark.createDataFrame([(bytearray(foreign()),), (None,), (bytearray(b"junk data"),)], "media binary")
    seen = media.probe(odd).collect()
    assert seen[0].codec == "mp4a" and len(seen[0].key_ranges) == 2 and seen[1].error is None and seen[2].error


def test_feature_and_clashing_columns(spark):
    """The feature, from the writer's own rules: samples of 192 bytes, a key frame every twelfth, samples end to end."""
    texts = {1: None, 2: "x" * 192, 3: "é" * 5000, 4: ""}
    df = spark.createDataFrame([(i, t, "mine", "mine") for i, t in texts.items()] * 2, "doc_id long, text string, feature string, codec string")
    stored = media.store_text(df, drop=("text",))
    out = media.read_back(stored).collect()
    assert len(out) == 8 and {r.codec for r in out} == {"mine"}
    for r in out:
        n = max(1, -(-len((texts[r.doc_id] or "").encode()) // media.SAMPLE))
        first = r.media_bytes - n * media.SAMPLE
        ranges = ",".join(f"{first + k * media.SAMPLE}+{media.SAMPLE}" for k in range(0, n, media.KEY_EVERY))
        assert r.feature == f"codec=raw;timescale={media.TIMESCALE};duration={n};samples={n};keys={-(-n // media.KEY_EVERY)};ranges={ranges}"
    assert media.read_back(media.store_text(df.limit(0))).collect() == []
