"""Byte-level BPE: encoding with a sentencepiece model serialised from a rank vocabulary, and decoding."""

from __future__ import annotations

import base64
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronolex.llm.common import batched, slices

#: Words that a Python worker remembers with their ids, and the longest that it remembers.
MEMO_WORDS, MEMO_CHARS = 400_000, 64
#: Documents that are encoded together.
CHUNK = 256


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a file of base64 tokens and ranks, in the order of the ranks."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def byte_chars() -> list[str]:
    """A visible character for each byte: printable Latin-1 bytes stand for themselves, the others are moved up."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars = {b: chr(b) for b in keep}
    for b in range(256):
        chars.setdefault(b, chr(256 + len(chars) - len(keep)))
    return [chars[b] for b in range(256)]


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _field(number: int, value: bytes | int) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model whose piece ids are the ranks.

    Pieces are byte-mapped tokens with the negative rank as score, so the merge that comes first in the
    vocabulary wins; the normaliser is the identity. The obligatory unknown piece follows the last rank; it
    can't occur, since each byte is a token.
    """
    chars = byte_chars()
    parts = []
    for rank, token in enumerate(tokens):
        piece = "".join(chars[b] for b in token).encode()
        parts.append(_field(1, _field(1, piece) + _varint(2 << 3 | 5) + struct.pack("<f", -float(rank)) + _field(3, 1)))
    parts.append(_field(1, _field(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _field(3, 2)))
    none = (1 << 64) - 1  # -1: no such piece
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens)) + b"".join(_field(n, none) for n in (41, 42, 43))
    normaliser = _field(1, b"identity") + b"".join(_field(n, 0) for n in (3, 4, 5))
    return b"".join(parts) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encodes texts word by word, and decodes ids."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import regex
        import sentencepiece

        self.whole = {t: i for i, t in enumerate(tokens)}
        self.split = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(tokens))
        chars = byte_chars()
        self.to_chars = {b: c for b, c in enumerate(chars)}
        self.memo: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """Little-endian int32 ids of words; a word that is a token is that token, without merges."""
        raw = [w.encode() for w in new]
        ids = self.model.encode([b.decode("latin-1").translate(self.to_chars) for b in raw], out_type=int, num_threads=1)
        return {w: np.array([self.whole[b]] if b in self.whole else i, "<i4").tobytes() for w, b, i in zip(new, raw, ids)}

    def encode(self, texts: list[str]) -> list[bytes]:
        lists = [self.split(t) for t in texts]
        need = [w for w in set().union(*lists) if w not in self.memo]
        extra = {}
        if need:
            learnt = self._learn(need)
            if len(self.memo) + len(learnt) > MEMO_WORDS:
                extra, self.memo = self.memo, {}
                self.memo.update((w, x) for w, x in learnt.items() if len(w) <= MEMO_CHARS)
                extra.update(learnt)
                return [b"".join(map(extra.__getitem__, ws)) for ws in lists]
            long = {w: learnt.pop(w) for w in list(learnt) if len(w) > MEMO_CHARS}
            self.memo.update(learnt)
            if long:
                extra = self.memo | long
        get = (extra or self.memo).__getitem__
        return [b"".join(map(get, ws)) for ws in lists]


class Decoder:
    """The bytes of each id: its piece in the model, mapped back from characters to bytes."""

    def __init__(self, tokens: list[bytes]):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(tokens))
        to_bytes = {c: b for b, c in enumerate(byte_chars())}
        pieces = [bytes(map(to_bytes.__getitem__, model.id_to_piece(i))) for i in range(len(tokens))]
        self.table = np.array([*pieces, b""], dtype=object)

    def decode(self, ids: np.ndarray) -> list[bytes]:
        return self.table[ids].tolist()


#: What a worker keeps from one task to the next: vocabulary and pattern, and what was made of them.
_kept: dict = {}


def _get(kind: type, *of):
    if kind not in _kept or _kept[kind][0] != of:
        _kept[kind] = (of, kind(*of))
    return _kept[kind][1]


def encode(df: DataFrame, tokens: list[bytes], pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Append the array column ``out`` of token ids; a null or empty text gets an empty array.

    An input column of that name is replaced; all others pass through. The vocabulary (its size is that of the file,
    not of the data) is broadcast; documents stay in their partition.
    """
    shared = df.sparkSession.sparkContext.broadcast(tokens)
    df = df.drop(out)
    at = df.columns.index(text)

    def run(batches):
        codec = _get(Codec, shared.value, pattern)
        for whole in batches:
            for batch in slices(whole, at, CHUNK):
                raw = codec.encode([t or "" for t in batch.column(at).to_pylist()])
                ends = np.cumsum([0] + [len(x) // 4 for x in raw])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(raw), "<i4")))
                yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, out])

    return batched(df).mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, tokens: list[bytes], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Append the binary column ``out`` with the bytes of the ids (null: none)."""
    shared = df.sparkSession.sparkContext.broadcast(tokens)
    df = df.drop(out)
    at = df.columns.index(ids)

    def run(batches):
        codec = _get(Decoder, shared.value)
        for whole in batches:
            for k in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(k, CHUNK)
                col = batch.column(at)
                ends = np.asarray(col.offsets)
                flat = codec.decode(np.asarray(col.values)[ends[0] : ends[-1]])
                ends = ends - ends[0]
                got = pa.array([b"".join(flat[a:b]) for a, b in zip(ends, ends[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, got], [*batch.schema.names, out])

    return batched(df).mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())]))


def digests(df: DataFrame, tokens: list[bytes], pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 and decoded_sha256."""
    coded = encode(df.select("doc_id", "text"), tokens, pattern).select("doc_id", "ids")
    return decode(coded, tokens).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
