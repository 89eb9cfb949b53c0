"""Byte-level BPE: encoding with contiguous rank arrays, and decoding.

A text is cut at white space into chunks, a chunk into pieces by the vocabulary's pattern, and each
piece is merged on its own.  For a short piece two arrays are held, the boundaries of its parts and the
rank of each part's merge with its right neighbour; the least rank is found by a scan, its boundary
deleted and the two neighbouring ranks refreshed from the bytes between boundaries.  The scan is
quadratic, so pieces above ``SHORT`` bytes use a heap over linked parts, which applies the same merges
in the same order.

Chunks and pieces are memoised in bounded tables.  Special tokens in a text become their own ids; the
leftmost wins, and of those that begin together the longest.  Null texts count as empty: no tokens.
Rows that repeat are encoded like any other, very long texts whole, in memory of the order of the text;
an empty table gives an empty result.  All other columns stay; those named like a new column give way.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lodestone.llm.batches import with_columns

SHORT = 200
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters with the White_Space property.
_WHITE = "\t-\r \x85\xa0  -     　"
_CHUNK = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
_NEVER = 1 << 30
_MEMO = 400_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class Vocabulary:
    """Merge ranks and token bytes out of a tokenizer file in JSON."""

    def __init__(self, data: bytes):
        import regex

        spec = json.loads(data)
        ids, letters = spec["model"]["vocab"], byte_letters()
        to_byte = {c: b for b, c in enumerate(letters)}
        self.byte_ids = [ids[c] for c in letters]
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        #: Rank of the merge of two parts, by their bytes.
        self.joins: dict[tuple[bytes, bytes], int] = {}
        spelled = lambda token: bytes(to_byte[c] for c in token)
        for pair in spec["model"]["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault(ids[a] << 32 | ids[b], len(self.merged))
            self.joins.setdefault((spelled(a), spelled(b)), len(self.merged))
            self.merged.append(ids[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        self.id_of: dict[bytes, int] = {}
        for token, i in ids.items():
            if all(c in to_byte for c in token):
                self.bytes_of[i] = spelled(token)
                self.id_of[self.bytes_of[i]] = i
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        names = sorted(self.special, key=len, reverse=True)
        self.split_special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.pieces = regex.compile(PATTERN).findall

    def merge_short(self, data: bytes) -> list[int]:
        cuts = list(range(len(data) + 1))
        rank_of, id_of = self.joins.get, self.id_of
        ranks = [rank_of((data[i : i + 1], data[i + 1 : i + 2]), _NEVER) for i in range(len(data) - 1)]
        while ranks and (least := min(ranks)) < _NEVER:
            i = ranks.index(least)
            del cuts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank_of((data[cuts[i] : cuts[i + 1]], data[cuts[i + 1] : cuts[i + 2]]), _NEVER)
            if i:
                ranks[i - 1] = rank_of((data[cuts[i - 1] : cuts[i]], data[cuts[i] : cuts[i + 1]]), _NEVER)
        return [id_of[data[a:b]] for a, b in zip(cuts, cuts[1:])]

    def merge_long(self, data: bytes) -> list[int]:
        ids = [self.byte_ids[b] for b in data]
        n = len(ids)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        rank_of = self.ranks.get
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank_of(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = right[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = self.merged[rank], -1
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (r := rank_of(ids[i] << 32 | ids[k])) is not None:
                    heapq.heappush(heap, (r, i, ids[i], ids[k]))
            if (h := left[i]) >= 0 and (r := rank_of(ids[h] << 32 | ids[i])) is not None:
                heapq.heappush(heap, (r, h, ids[h], ids[i]))
        return [x for x in ids if x >= 0]


class _PieceMemo(dict):
    """Token ids, as little-endian 32-bit bytes, of each piece."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode()
        if len(data) > SHORT:
            return np.array(self.vocabulary.merge_long(data), "<u4").tobytes()
        if len(self) > _MEMO:
            self.clear()
        out = self[piece] = b"".join([i.to_bytes(4, "little") for i in self.vocabulary.merge_short(data)])
        return out


class Encoder(dict):
    """Encodes texts; itself the memo of chunks."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.memo = vocabulary, _PieceMemo(vocabulary)

    def __missing__(self, chunk: str) -> bytes:
        out = b"".join([self.memo[p] for p in self.vocabulary.pieces(chunk)])
        if len(chunk) <= SHORT:
            if len(self) > _MEMO:
                self.clear()
            self[chunk] = out
        return out

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.vocabulary.split_special is None or not self.vocabulary.split_special.search(text):
            return b"".join([self[c] for c in _CHUNK.findall(text)])
        special = self.vocabulary.special
        return b"".join(
            [special[part].to_bytes(4, "little") if part in special else b"".join([self[c] for c in _CHUNK.findall(part)]) for part in self.vocabulary.split_special.split(text)]
        )

    def decode(self, ids: bytes) -> str:
        tokens = self.vocabulary.bytes_of
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def read_vocabulary(path: str, max_bytes: int = 1 << 26) -> bytes:
    """The file on the driver; it travels to the executors, so its size is checked."""
    with open(path, "rb") as f:
        data = f.read(max_bytes + 1)
    if len(data) > max_bytes:
        raise ValueError(f"{path} has more than {max_bytes} bytes")
    return data


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


_STATS = T.StructType(
    [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
)
_IDS = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))])
_TEXT = T.StructType([T.StructField("decoded", T.StringType())])


def _with_encoder(df: DataFrame, column: str, path: str | None, fields: T.StructType, row, drop: tuple[str, ...] = ()) -> DataFrame:
    held = df.sparkSession.sparkContext.broadcast(read_vocabulary(path or default_path()))

    def start():
        encoder = Encoder(Vocabulary(held.value))

        def compute(values):
            made = [row(encoder, x) for x in values.to_pylist()]
            return [list(c) for c in zip(*made)] if made else [[] for _ in fields]

        return compute

    return with_columns(df, [column], fields, start, drop)


def encode(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with the token ids of each whole text in ``ids``."""
    return _with_encoder(docs, text_col, path, _IDS, lambda e, t: (np.frombuffer(e.encode(t), "<u4").astype(np.int32),))


def decode(df: DataFrame, ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """``df`` with the text of its token ids in ``decoded``."""
    return _with_encoder(df, ids_col, path, _TEXT, lambda e, x: (e.decode(np.array([] if x is None else x, "<u4").tobytes()),))


def round_trip(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` without the text, with the token count and digests of the ids and of the text decoded from them."""

    def row(encoder: Encoder, text: str | None):
        ids = encoder.encode(text)
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(encoder.decode(ids).encode()).hexdigest()

    return _with_encoder(docs, text_col, path, _STATS, row, (text_col,))
