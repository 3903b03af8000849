"""Exact top-k by inner product over a bit-sliced index.

Every component x becomes floor(scale * x). Rows are dealt by a hash of their id into blocks
of about block_rows; a block stores, for each component, the bits of (value - offset) as bitmaps
over its rows, offset being the block's smallest value. A query's score over a whole block
is the sum of the slices weighted by the query's bits: slices of equal weight are
added by carry-save adders on whole bitmaps, the positive and the negative part of the query
apart, and their difference is again a set of bitmaps. The top rows are then found from the most
significant slice downward; rows that tie at the boundary go in by smaller id. Blocks of queries meet
blocks of rows in a grid of tasks, each of bounded memory, and the k best of each pair are
merged. Everything is integer arithmetic, so results are exact.

A vector takes no part if it is null or holds a null or a non-finite component, or if its id
is null. Nor does one that is too large for 64-bit scores: length * (scale * largest component) ** 2 has
to stay under 2 ** 62, so that the inner product of any two that take part is a long. Vectors of different lengths don't meet: a query only sees candidates of its own length. A repeated id
counts once, with its lexicographically smallest vector. An empty vector scores 0 with the other
empty ones. Fewer than k candidates are all returned. Columns other than the id and the vector are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

BLOCK = "dim int, block long, n long, width int, lowest long, ids binary, slices binary"


def quantised(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: Column, scale: int) -> Column:
    """Not null, without null or non-finite components, and small enough for 64-bit scores."""
    largest = (2.0**31 - 1) / F.sqrt(F.size(vector).cast("double")) / scale - 1
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < largest))


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and values (rows by components) of a block, each id once, in the order of ids."""
    ids = table["id"].to_numpy()
    values = pa.concat_arrays(table["v"].chunks).flatten()
    m = values.to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(ids), -1)
    order = np.lexsort([*m.T[::-1], ids])
    ids, m = ids[order], m[order]
    first = np.ones(len(ids), dtype=bool)
    first[1:] = ids[1:] != ids[:-1]
    return ids[first], m[first]


def build_block(table: pa.Table) -> pa.Table:
    """A block of rows as bit slices: component by component, the lowest bit first, 64 rows to a word."""
    ids, m = _matrix(table)
    lowest = int(m.min()) if m.size else 0
    u = (m - lowest).T  # components by rows
    width = max(1, int(u.max()).bit_length()) if m.size else 1
    padded = np.zeros((u.shape[0], -(-len(ids) // 64) * 64), dtype=np.int64)
    padded[:, : len(ids)] = u
    slices = [np.packbits((padded >> b & 1).astype(np.uint8), axis=1, bitorder="little") for b in range(width)]
    data = np.stack(slices, axis=1) if m.size else np.zeros((0, width, padded.shape[1] // 8), dtype=np.uint8)
    return pa.table({
        "dim": pa.array([m.shape[1]], pa.int32()), "block": table["block"].slice(0, 1), "n": pa.array([len(ids)], pa.int64()), "width": pa.array([width], pa.int32()),
        "lowest": pa.array([lowest], pa.int64()), "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()), "slices": pa.array([data.tobytes()], pa.binary()),
    })


def pack_queries(table: pa.Table) -> pa.Table:
    """A block of queries: ids and values, row by row."""
    ids, m = _matrix(table)
    return pa.table({
        "dim": pa.array([m.shape[1]], pa.int32()), "block": table["block"].slice(0, 1), "n": pa.array([len(ids)], pa.int64()),
        "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()), "vectors": pa.array([m.astype("<i8").tobytes()], pa.binary()),
    })


def _add_columns(columns: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """The sum of bitmaps, each with the weight 2 ** its column, as bits from the lowest up. Three of a column become one and a carry."""
    bits: list[np.ndarray] = []
    weight = 0
    while weight <= max(columns, default=-1):
        pile = columns.get(weight, [])
        above = columns.setdefault(weight + 1, []) if len(pile) > 1 else []
        while len(pile) > 2:
            new = []
            for i in range(0, len(pile) - 2, 3):
                a, b, c = pile[i : i + 3]
                x = a ^ b
                new.append(x ^ c)
                above.append((a & b) | (x & c))
            pile = new + pile[len(pile) - len(pile) % 3 :]
        if len(pile) == 2:
            above.append(pile[0] & pile[1])
            pile = [pile[0] ^ pile[1]]
        bits.append(pile[0] if pile else None)
        weight += 1
    return bits


def _subtract(a: list, b: list, zero: np.ndarray) -> list[np.ndarray]:
    """a - b + 2 ** width as width + 1 bits, so that larger is larger: the top bit is set where a >= b."""
    width = max(len(a), len(b), 1)
    out, borrow = [], zero
    for i in range(width):
        x = a[i] if i < len(a) and a[i] is not None else zero
        y = b[i] if i < len(b) and b[i] is not None else zero
        d = x ^ y
        out.append(d ^ borrow)
        borrow = (~x & y) | (~d & borrow)
    return [*out, ~borrow]


def block_scores(slices: np.ndarray, query: np.ndarray) -> list[np.ndarray]:
    """Bits of sum(query * u) + 2 ** width over a block's rows. slices: components by bits by words."""
    plus: dict[int, list[np.ndarray]] = {}
    minus: dict[int, list[np.ndarray]] = {}
    for component, q in enumerate(query.tolist()):
        side, q = (plus, q) if q > 0 else (minus, -q)
        shift = 0
        while q:
            if q & 1:
                for bit in range(slices.shape[1]):
                    side.setdefault(bit + shift, []).append(slices[component, bit])
            q >>= 1
            shift += 1
    return _subtract(_add_columns(plus), _add_columns(minus), np.zeros(slices.shape[2], dtype=np.uint64))


def _positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def top_rows(bits: list[np.ndarray], rows: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of the rows in the bitmap; of those that tie at the boundary the first."""
    sure, open_ = np.zeros_like(rows), rows
    for b in reversed(bits):
        more = sure | (open_ & b)
        n = int(np.bitwise_count(more).sum())
        if n > k:
            open_ = open_ & b
        else:
            sure, open_ = more, open_ & ~b
            if n == k:
                return _positions(sure)
    found = _positions(sure)
    return np.concatenate([found, _positions(open_)[: k - len(found)]])


def _values(bits: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    """The numbers that the bits hold at some rows, less the 2 ** width."""
    total = np.full(len(at), -(1 << (len(bits) - 1)), dtype=np.int64)
    for i, b in enumerate(bits):
        total += (b[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64) << i
    return total


def _search(k: int):
    def run(queries: pa.Table, blocks: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        for ids, n, width, lowest, data, dim in zip(*(blocks[c].to_pylist() for c in ("ids", "n", "width", "lowest", "slices", "dim")), strict=True):
            row_ids = np.frombuffer(ids, dtype="<i8")
            words = -(-n // 64)
            slices = np.frombuffer(data, dtype=np.uint64).reshape(dim, width, words)
            everyone = np.packbits(np.arange(words * 64) < n, bitorder="little").view(np.uint64)
            for q_ids, q_data in zip(queries["ids"].to_pylist(), queries["vectors"].to_pylist(), strict=True):
                asked = np.frombuffer(q_ids, dtype="<i8")
                vectors = np.frombuffer(q_data, dtype="<i8").reshape(len(asked), dim)
                own = np.searchsorted(row_ids, asked)
                for q, v, at in zip(asked.tolist(), vectors, own.tolist(), strict=True):
                    bits, rows = block_scores(slices, v), everyone
                    if at < n and row_ids[at] == q:
                        rows = everyone.copy()
                        rows[at >> 6] &= ~(np.uint64(1) << np.uint64(at & 63))
                    best = top_rows(bits, rows, k)
                    out[0].append(np.full(len(best), q))
                    out[1].append(row_ids[best])
                    out[2].append(_values(bits, best) + lowest * int(v.sum()))
        cols = [np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64) for c in out]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), cols, strict=True)))

    return run


def top_k(vectors: DataFrame, *, k: int = 20, scale: int = 64, query_every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = 65536, query_rows: int = 2048) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id query_every divides, its k best among all others."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).filter(F.col("id").isNotNull() & usable(F.col("v"), scale))
    rows = C.materialise(rows.select("id", quantised(F.col("v"), scale).alias("v"), F.size("v").alias("dim")), "vectors")
    blocks = max(1, -(-rows.count() // block_rows))
    asked = rows.filter(F.pmod("id", F.lit(query_every)) == 0)
    parts = max(1, -(-asked.count() // query_rows))

    def dealt(df: DataFrame, n: int) -> DataFrame:
        return df.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n)))

    index = C.materialise(dealt(rows, blocks).groupBy("dim", "block").applyInArrow(build_block, BLOCK), "bit-slices")
    packed = C.materialise(dealt(asked, parts).groupBy("dim", "block").applyInArrow(pack_queries, "dim int, block long, n long, ids binary, vectors binary"), "queries")
    C.discard(rows)
    # each block of queries goes to each block of rows: a grid of blocks x parts tasks
    left = packed.select("dim", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("row_block"), F.col("block").alias("query_block"), "ids", "vectors")
    right = index.select("dim", F.col("block").alias("row_block"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("query_block"), "n", "width", "lowest", "ids", "slices")
    cell = ["dim", "row_block", "query_block"]
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(_search(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
