"""Byte-level BPE through sentencepiece, from a rank file.

The model is serialised here, field by field, from the vocabulary: each token's bytes are
written as characters, byte b as the character U+0100 + b, which no normalisation or white
space rule touches, and its score is minus its rank. Sentencepiece's BPE merges the best
scored pair first and the leftmost of equals, which is the order of ranks. The normaliser is
the identity. A text is cut into pre-tokens by the pattern; a pre-token that is itself a
token is that token, the others are encoded by the model. Ids are the ranks. Decoding maps
each id to its bytes and joins them.

A null text is empty: no ids, and it decodes to no bytes. Texts of any length are encoded
whole. Each row is encoded by itself, so repeated rows and other columns don't matter, and an
empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pre-tokens whose ids a worker remembers at most in each of two generations; when the younger is full it replaces the older.
REMEMBERED = 100_000
#: Only shorter pre-tokens are remembered.
REMEMBERED_CHARS = 40
#: A worker hands on what it has once ids and decoded bytes come to this.
PORTION_BYTES = 4 << 20


def read_ranks(data: bytes) -> list[bytes]:
    """Token bytes by rank; ranks must run from 0 without gaps."""
    pairs = sorted((int(r), base64.b64decode(t)) for t, r in map(bytes.split, data.splitlines()) if t)
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks have gaps")
    return [t for _, t in pairs]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    """A protocol buffer field: bytes as length-delimited, int as varint, float as 32 bits."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


#: Byte to character and back.
_UP = {b: chr(0x100 + b) for b in range(256)}
_TABLE = [_UP[b] for b in range(256)]


def mapped(data: bytes) -> str:
    """Each byte b as U+0100 + b."""
    return data.decode("latin-1").translate(_UP)


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose ids are the ranks; the unknown piece comes last and is never met."""
    normal, unknown, bpe = 1, 2, 2
    pieces = [_field(1, _field(1, mapped(t).encode()) + _field(2, float(-r)) + _field(3, normal)) for r, t in enumerate(tokens)]
    pieces.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown)))
    trainer = _field(3, bpe) + _field(4, len(tokens) + 1) + _field(40, len(tokens)) + _field(24, 0) + b"".join(_field(n, (1 << 64) - 1) for n in (41, 42, 43))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


def newer_characters() -> dict[str, list[tuple[int, int]]]:
    """Ranges of code points that the regex package calls letters or numbers and the tokenizer's library does not.

    The two know different versions of Unicode. Found by letting the library cut a text of all code points.
    """
    import regex
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    found: dict[str, list[tuple[int, int]]] = {}
    for kind in (r"\p{L}", r"\p{N}"):
        judge = tiktoken.Encoding("probe", pat_str=kind, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        theirs = set(bytes(judge.encode_ordinary(every)).decode())
        ranges: list[tuple[int, int]] = []
        for c in map(ord, regex.findall(kind, every)):
            if chr(c) not in theirs:
                ranges = [*ranges[:-1], (ranges[-1][0], c)] if ranges and ranges[-1][1] == c - 1 else [*ranges, (c, c)]
        found[kind] = ranges
    return found


def _set_of(ranges: list[tuple[int, int]]) -> str:
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


def compile_cut(pattern: str, newer: dict[str, list[tuple[int, int]]]):
    """The function that cuts a text into pre-tokens. Only texts with newer characters take the pattern that excludes these."""
    import re

    import regex

    plain = regex.compile(pattern).findall
    if not any(newer.values()):
        return plain
    odd = re.compile("[" + "".join(map(_set_of, newer.values())) + "]").search
    for kind, ranges in newer.items():
        if ranges:
            pattern = pattern.replace(kind, f"[{kind}--[{_set_of(ranges)}]]")
    exact = regex.compile(pattern, regex.V1).findall
    return lambda text: plain(text) if text.isascii() or not odd(text) else exact(text)


class Codec:
    """Encodes and decodes texts; one for each Python worker."""

    def __init__(self, ranks: bytes, pattern: str, newer: dict[str, list[tuple[int, int]]] | None = None):
        import sentencepiece

        self.tokens = read_ranks(ranks)
        self.whole = {t: r for r, t in enumerate(self.tokens)}
        self.model = sentencepiece.SentencePieceProcessor()
        self.model.LoadFromSerializedProto(serialise_model(self.tokens))
        self.cut = compile_cut(pattern, newer_characters() if newer is None else newer)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, pre_tokens: list[str]) -> list[bytes]:
        """The ids of each pre-token, as little-endian 32-bit integers."""
        data = [p.encode() for p in pre_tokens]
        split = self.model.encode([mapped(d) for d, p in zip(data, pre_tokens, strict=True) if d not in self.whole], out_type=int, num_threads=1)
        rest = iter(split)
        return [struct.pack("<I", w) if (w := self.whole.get(d)) is not None else struct.pack(f"<{len(i := next(rest))}I", *i) for d in data]

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian 32-bit integers."""
        pre, known, older = self.cut(text), self.known, self.older
        here = known
        new = [p for p in set(pre) if p not in known]
        if new:
            found = {p: older[p] for p in new if p in older}
            unseen = [p for p in new if p not in found]
            found.update(zip(unseen, self._ids(unseen), strict=True))
            kept = {k: v for k, v in found.items() if len(k) <= REMEMBERED_CHARS}
            full = len(known) + len(kept) > REMEMBERED
            if full or len(kept) < len(found):
                here = {p: found[p] if p in found else known[p] for p in set(pre)}
            if full:
                self.older, self.known = known, kept if len(kept) <= REMEMBERED else {}
            else:
                known.update(kept)
        return b"".join([here[p] for p in pre])

    def decode(self, ids: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in memoryview(ids).cast("I")])


_codecs: dict[tuple[int, str], Codec] = {}


def codec_for(ranks: bytes, pattern: str, newer: dict[str, list[tuple[int, int]]]) -> Codec:
    key = (hash(ranks), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(ranks, pattern, newer)
    return _codecs[key]


def _read(path: str | None) -> bytes:
    with open(C.data_file(path, VOCABULARY), "rb") as f:
        return f.read()


def encoded(codec: Codec, batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The rows of schema (see encode_decode) of batches of ids and texts, in batches of PORTION_BYTES and a row at most."""
    for batch in batches:
        cols, held = [[] for _ in schema], 0
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids = codec.encode(text.as_py() or "")
            back = codec.decode(ids)
            row = [doc, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest(), ids, back]
            for c, v in zip(cols, row, strict=False):
                c.append(v)
            held += sum(map(len, row[4 : len(cols)]))
            if held >= PORTION_BYTES:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)
                cols, held = [[] for _ in schema], 0
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def encode_decode(docs: DataFrame, *, vocabulary: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text", contents: bool = True, decoded: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256; with contents also ids (little-endian 32-bit) and, unless they are left out, decoded bytes."""
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    # the vocabulary file is of fixed size (about 1 MB) and read where the driver is
    ranks = docs.sparkSession.sparkContext.broadcast(_read(vocabulary))
    newer = newer_characters()
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    fields += [("ids", pa.binary()), ("decoded", pa.binary())][: contents * (1 + decoded)]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return encoded(codec_for(ranks.value, pattern, newer), batches, schema)

    names = {"int64": "long", "string": "string", "binary": "binary"}
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, ", ".join(f"{n} {names[str(t)]}" for n, t in fields))
