import base64
import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tidemark.llm import bpe

RANKS = open(public_tokenizers.path(bpe.VOCABULARY), "rb").read()


@pytest.fixture(scope="module")
def judge():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(3)
    pools = ["abc XYZ 019 \n\t.,!'", "äöü ßéèñ ¿", "日本語 の テキスト", "🙂👍🏽 ‍﻿\x00\x1c\x85\xa0　 ", "".join(map(chr, range(1, 0x250)))]
    for n in (0, 1, 2, 5, 20, 200):
        for pool in pools:
            for _ in range(6):
                yield "".join(rng.choice(pool) for _ in range(n))
    yield "a" * 5000 + " " * 700 + "it's we'll THE'S \r\n\r\n end  "
    yield "".join(chr(rng.choice([rng.randrange(32, 0xD7FF), rng.randrange(0xE000, 0x10FFFF)])) for _ in range(3000))


def test_same_ids_as_the_library_and_round_trip(judge):
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    for t in texts():
        ids = codec.encode(t)
        assert list(memoryview(ids).cast("I")) == judge.encode_ordinary(t), repr(t[:80])
        assert codec.decode(ids) == t.encode()


def test_memory_is_bounded(judge, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    for t in texts():
        assert list(memoryview(codec.encode(t)).cast("I")) == judge.encode_ordinary(t)
        assert len(codec.known) <= 5


def test_rows(spark, judge):
    docs = spark.createDataFrame([(1, "Hello  world", "x"), (1, "Hello  world", "x"), (None, None, "y"), (3, "", None)], "doc_id long, text string, ids string")
    rows = bpe.encode_decode(docs).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == [(0, 0), (1, len(judge.encode_ordinary("Hello  world"))), (1, len(judge.encode_ordinary("Hello  world"))), (3, 0)]
    assert all(hashlib.sha256(r.ids).hexdigest() == r.ids_sha256 and hashlib.sha256(r.decoded).hexdigest() == r.decoded_sha256 for r in rows)
    assert bpe.encode_decode(docs.limit(0)).count() == 0


def test_rows_are_handed_on_in_portions(monkeypatch):
    """A whole task's ids and decoded bytes once made a single batch."""
    monkeypatch.setattr(bpe, "PORTION_BYTES", 1000)
    codec, texts = bpe.Codec(RANKS, public_tokenizers.PATTERN), [*("word " * n for n in range(60)), None]
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("ids", pa.binary()), ("decoded", pa.binary())])
    given = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    found = list(bpe.encoded(codec, iter([given]), schema))
    assert len(found) > 5 and all(sum(len(r["ids"]) + len(r["decoded"]) for r in b.to_pylist()) < 2000 for b in found)
    rows = [r for b in found for r in b.to_pylist()]
    assert [r["doc_id"] for r in rows] == list(range(len(texts))) and [r["decoded"].decode() for r in rows] == [t or "" for t in texts]


def test_pretokens_that_come_again_outlive_a_full_memory(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 4)
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    codec.encode("qqzx wwzx eezx")
    codec.encode("rrzx ttzx")
    asked, ids = [], codec._ids
    monkeypatch.setattr(codec, "_ids", lambda p: asked.extend(p) or ids(p))
    codec.encode("qqzx yyzx")
    assert asked == [" yyzx"] and len(codec.known) + len(codec.older) <= 8


def test_decoded_bytes_can_be_left_out(spark):
    rows = bpe.encode_decode(spark.createDataFrame([(1, "Hello  world")], "doc_id long, text string"), decoded=False)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"] and rows.count() == 1
