import hashlib
import random
import struct

import pytest
from tokenizers import Tokenizer

from lodestone.llm import bpe


@pytest.fixture(scope="module")
def both():
    path = bpe.default_path()
    return bpe.Encoder(bpe.Vocabulary(bpe.read_vocabulary(path))), Tokenizer.from_file(path)


def ids_of(encoder, text):
    data = encoder.encode(text)
    return list(struct.unpack(f"<{len(data) // 4}I", data))


def test_equals_the_library(both):
    encoder, library = both
    rng = random.Random(1)
    letters = [*" \n\t\x0b\x1c\x85 　'aAbtsé1²_-<|>ñ😀漢́.,", "<|endoftext|>", "'ll", "  ", "token", "The ", "ingly"]
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        ids = ids_of(encoder, text)
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert encoder.decode(encoder.encode(text)) == library.decode(ids, skip_special_tokens=False) == text


def test_every_code_point_block(both):
    encoder, library = both
    for cp in [*range(0x3000), *range(0x3000, 0xD800, 37), *range(0xE000, 0x110000, 997)]:
        text = f"a{chr(cp)}{chr(cp)}b {chr(cp)}1"
        assert ids_of(encoder, text) == library.encode(text, add_special_tokens=False).ids


def test_short_and_long_pieces_agree(both):
    encoder, library = both
    rng = random.Random(2)
    for n in (1, 5, 199, 200, 201, 700):
        data = "".join(rng.choice("aabcdething") for _ in range(n)).encode()
        assert encoder.vocabulary.merge_short(data) == encoder.vocabulary.merge_long(data)
    for text in ("a" * 50_000, "thequick" * 5_000):
        assert ids_of(encoder, text) == library.encode(text, add_special_tokens=False).ids


def test_round_trip_query(spark, both):
    rows = [(1, "Hello wörld", "x"), (2, None, "x"), (2, "", None), (None, "two\n\nlines", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    out = bpe.round_trip(df).collect()
    assert len(out) == 4 and len(out[0]) == 4
    for r, (i, text, _) in zip(out, rows):
        ids = both[1].encode(text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.round_trip(df.limit(0)).collect() == []
    back = bpe.decode(bpe.encode(df)).collect()
    assert [r.decoded for r in back] == [t or "" for _, t, _ in rows]


def test_vocabulary_size_is_checked(tmp_path):
    (tmp_path / "v.json").write_bytes(b"x" * 100)
    with pytest.raises(ValueError):
        bpe.read_vocabulary(str(tmp_path / "v.json"), max_bytes=99)


def test_special_tokens_of_any_spelling(tmp_path):
    import json

    spec = json.loads(bpe.read_vocabulary(bpe.default_path()))
    for i, name in enumerate(("[EOT]", "[EOT]x", "ünd")):
        spec["added_tokens"].append({**spec["added_tokens"][0], "id": 50257 + i, "content": name})
    (tmp_path / "v.json").write_text(json.dumps(spec))
    encoder, library = bpe.Encoder(bpe.Vocabulary(bpe.read_vocabulary(str(tmp_path / "v.json")))), Tokenizer.from_file(str(tmp_path / "v.json"))
    for text in ("a [EOT] b", "[EOT]x[EOT]", "rund ünd", "no special", "<|endoftext|>[EO", ""):
        assert ids_of(encoder, text) == library.encode(text, add_special_tokens=False).ids


def test_boundaries_follow_the_bytes(both):
    """The parts of a short piece, end to end, are its bytes."""
    vocabulary = both[0].vocabulary
    rng = random.Random(6)
    for _ in range(300):
        data = bytes(rng.choice(b"abcdeing \xc3\xa9\xf0") for _ in range(rng.randint(1, 60)))
        assert b"".join(vocabulary.bytes_of[i] for i in vocabulary.merge_short(data)) == data
