"""Words of letters, digits and all that isn't ASCII, cut from UTF-8 bytes; used by lexical search and resampling."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A-Z becomes a-z; whatever is no digit, letter or part of a character beyond ASCII becomes a blank.
_TABLE = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())


def words_of(text: bytes | None) -> list[bytes]:
    """The maximal runs of [0-9a-z] and non-ASCII characters, A-Z lower-cased; none of a null text."""
    return text.translate(_TABLE).split() if text else []


def utf8(text: Column) -> Column:
    """What words_of takes, without a detour through Python's strings."""
    return text.cast("binary")


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches, one at a time, so that long texts aren't all held as Python objects."""
    for batch in batches:
        for row in zip(*batch.columns, strict=True):
            yield tuple(v.as_py() for v in row)
