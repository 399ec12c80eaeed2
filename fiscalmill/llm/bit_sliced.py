"""Exact top-k inner products with a bit-sliced index.

Vectors become whole numbers floor(1024 x). The index holds blocks of at most BLOCK vectors. In a block, every
component, counted from the block's smallest, is cut to its SLICES most significant bits, and each bit becomes a bitmap
over the block's rows (a slice).

For a query, score = constant + sum over components of |q| * u, where u is the component or, for a negative q, its
complement. The sum is made with bitmap arithmetic only: for each bit of |q| the slices of the components that have that
bit are added in a tree of full adders, and the partial sums are added at their place. The result is a bit-sliced sum per
row. Going from its most significant slice downward finds the value of the k-th row. The bits that were cut off raise a
score by at most a bound that depends on the query alone, so every row that can be among the k best has a sum of at
least that value less the bound: these boundary rows are scored exactly.

Queries and index blocks meet in blocks: each query goes to every index block once, by an equi-join on (block, query
group); the best k of every block are then ranked per query. Nothing is sampled, and no row is left out.

Defined cases: null vectors, vectors with null or non-finite components and rows without an id take no part; vectors of
another length than the query's are no candidates; scaled components are limited to 2**61 either way; scores are ranked
exactly (up to 38 digits), and one that does not fit a long is null; rows that repeat an id are
candidates each on their own, but never for a query of the same id; ties go to the smaller id; an empty table gives an
empty result; further columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from operator import mul

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fiscalmill.llm.common import own_columns
from fiscalmill.sources.staging import stage

SCALE = 1024
BLOCK = 8192
QUERIES_AT_ONCE = 16
QUERY_GROUP = 512
SLICES = 8
K = 10
LARGEST = float(1 << 61)

BLOCKS = "block long, dims int, ids binary, values binary"


def quantised(embeddings: DataFrame) -> DataFrame:
    """vec_id and the whole-number components of the vectors that take part."""
    own = own_columns(embeddings, "vec_id", "embedding")
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    limited = lambda x: F.floor(F.greatest(F.least(x.cast("double") * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))).cast("long")
    valid = own.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(usable)
    return valid.select(F.col("vec_id").cast("long"), F.transform("embedding", limited).alias("v"))


def _pack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        for dims, rows in part.groupby(part["v"].map(len)):
            for start in range(0, len(rows), BLOCK):
                some = rows.iloc[start : start + BLOCK]
                values = np.stack([np.asarray(v, np.int64) for v in some["v"]]) if dims else np.zeros((len(some), 0), np.int64)
                ids = some["vec_id"].to_numpy(np.int64)
                yield pd.DataFrame({"block": [0], "dims": [int(dims)], "ids": [ids.tobytes()], "values": [values.tobytes()]})


def index_blocks(vectors: DataFrame) -> DataFrame:
    """The index's blocks as a written table. A block has rows of one task and one length."""
    packed = vectors.mapInPandas(_pack, BLOCKS)
    return stage(packed.withColumn("block", F.monotonically_increasing_id()), "bit-sliced-index")


def slices_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bitmaps [component, bit, word] of a block with lowest value, width and cut bits of each component."""
    n, dims = values.shape
    low = values.min(axis=0).astype(np.int64)
    above = values.astype(np.int64) - low
    width = np.array([int(x).bit_length() for x in above.max(axis=0)], np.int64)
    cut = np.maximum(0, width - SLICES)
    coarse = above >> cut
    words = (n + 63) // 64
    bits = np.zeros((dims, SLICES, words * 64), np.uint8)
    for j in range(SLICES):
        bits[:, j, :n] = ((coarse >> j) & 1).T
    return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64), low, width, cut


def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bit-sliced sum of two stacks [..., bit, word] of any number of bits."""
    bits = max(a.shape[-2], b.shape[-2])
    out = np.zeros((*np.broadcast_shapes(a.shape[:-2], b.shape[:-2]), bits + 1, a.shape[-1]), np.uint64)
    carry = np.uint64(0)
    for j in range(bits):
        x = a[..., j, :] if j < a.shape[-2] else np.uint64(0)
        y = b[..., j, :] if j < b.shape[-2] else np.uint64(0)
        either = x ^ y
        out[..., j, :] = either ^ carry
        carry = (x & y) | (either & carry)
    out[..., bits, :] = carry
    return out


def add_all(stack: np.ndarray) -> np.ndarray:
    """Sum over the first-but-one axis [query, component, bit, word] by a tree of adders."""
    while stack.shape[1] > 1:
        half = stack.shape[1] // 2
        summed = add(stack[:, :half], stack[:, half : 2 * half])
        if stack.shape[1] % 2:
            last = np.zeros((stack.shape[0], 1, *summed.shape[2:]), np.uint64)
            last[:, :, : stack.shape[2]] = stack[:, -1:]
            summed = np.concatenate([summed, last], axis=1)
        stack = summed
    return stack[:, 0]


def sliced_scores(slices: np.ndarray, width: np.ndarray, cut: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Bit-sliced sums [query, bit, word] of |q| * (component or complement), cut bits left out.

    Components are grouped by cut bits, so that slices of one place are added.
    """
    n_queries, words = len(queries), slices.shape[-1]
    size = np.abs(queries)
    valid = np.arange(SLICES) < np.minimum(width, SLICES)[:, None]
    flips = np.where(valid, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))[:, :, None]
    total = np.zeros((n_queries, 1, words), np.uint64)
    for s in np.unique(cut):
        own = np.flatnonzero(cut == s)
        plain = slices[own]
        signed = np.where((queries[:, own] < 0)[:, :, None, None], plain ^ flips[own], plain)
        for b in range(int(size[:, own].max(initial=0)).bit_length()):
            used = ((size[:, own] >> b) & 1).astype(bool)
            part = add_all(np.where(used[:, :, None, None], signed, np.uint64(0)))
            place = int(s) + b
            total = add(total, np.concatenate([np.zeros((n_queries, place, words), np.uint64), part], axis=1))
    return total


def kth_value(total: np.ndarray, candidates: np.ndarray, k: int) -> list[int]:
    """For every query the k-th largest sum among the candidate rows (the smallest, if there are fewer)."""
    found = []
    for sums, open_rows in zip(total, candidates, strict=True):
        wanted, value, equal = k, 0, open_rows
        for j in range(len(sums) - 1, -1, -1):
            ones = equal & sums[j]
            n = int(np.bitwise_count(ones).sum())
            if n >= wanted:
                value, equal = value | (1 << j), ones
            else:
                wanted -= n
                equal = equal & ~sums[j]
        found.append(value if equal.any() else 0)
    return found


def at_least(sums: np.ndarray, value: int) -> np.ndarray:
    """Bitmap of the rows whose bit-sliced sum is not below a value."""
    above, equal = np.zeros_like(sums[0]), np.full_like(sums[0], 0xFFFFFFFFFFFFFFFF)
    if value >> len(sums):
        return above
    for j in range(len(sums) - 1, -1, -1):
        if value >> j & 1:
            equal = equal & sums[j]
        else:
            above |= equal & sums[j]
            equal = equal & ~sums[j]
    return above | equal


def search_block(ids: np.ndarray, values: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(number of the query, id, score) of the k best rows of one block for every query."""
    n, dims = values.shape
    if not dims:
        slices, width, cut = np.zeros((0, SLICES, (n + 63) // 64), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    else:
        slices, _, width, cut = slices_of(values)
    # Sums that could pass 64 bits are made of Python's integers.
    exact = int(np.abs(values).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(1, dims) >> 62 > 0
    real = np.zeros(slices.shape[-1] * 64, np.uint8)
    for start in range(0, len(queries), QUERIES_AT_ONCE):
        some, own = queries[start : start + QUERIES_AT_ONCE], query_ids[start : start + QUERIES_AT_ONCE]
        if dims:
            total = sliced_scores(slices, width, cut, some)
        else:
            total = np.zeros((len(some), 1, slices.shape[-1]), np.uint64)
        candidates = np.empty((len(some), slices.shape[-1]), np.uint64)
        for i, query_id in enumerate(own):
            real[:n] = ids != query_id
            candidates[i] = np.packbits(real, bitorder="little").view(np.uint64)
        size, lost = np.abs(some), (1 << cut) - 1
        bounds = [sum(map(mul, q, lost.tolist())) for q in size.tolist()] if exact else (size * lost).sum(axis=1)
        for i, value in enumerate(kth_value(total, candidates, k)):
            boundary = at_least(total[i], max(0, value - int(bounds[i]))) & candidates[i]
            rows = np.flatnonzero(np.unpackbits(boundary.view(np.uint8), bitorder="little"))
            if exact:
                scores = [sum(map(mul, v, some[i].tolist())) for v in values[rows].tolist()]
                best = sorted(range(len(rows)), key=lambda j: (-scores[j], ids[rows[j]]))[:k]
            else:
                scores = values[rows] @ some[i]
                best = np.lexsort((ids[rows], -scores))[:k]
            for j in best:
                yield start + i, int(ids[rows[j]]), int(scores[j])


FOUND = "query long, query_id long, vec_id long, score decimal(38,0)"
MOST = 10**38 - 1


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """The k best vectors for every query row: query_id, rank, vec_id, score. Both inputs as `quantised` gives them."""
    index = index_blocks(vectors)
    numbered = stage(queries.withColumn("query", F.monotonically_increasing_id()), "bit-sliced-queries")
    groups = max(1, -(-numbered.count() // QUERY_GROUP))
    blocks = index.select(F.col("block").alias("to_block"), F.col("dims").alias("length")).distinct()
    left = index.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<int>")))
    asked = numbered.select("query", F.col("vec_id").alias("query_id"), "v", F.size("v").alias("length"))
    asked = asked.withColumn("group", F.pmod(F.xxhash64("query"), F.lit(groups)).cast("int")).join(blocks, "length")

    def search(key: tuple, blocks: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int, Decimal]] = []
        for _, row in blocks.iterrows():
            if not len(asked):
                break
            ids = np.frombuffer(row["ids"], np.int64)
            values = np.frombuffer(row["values"], np.int64).reshape(len(ids), row["dims"])
            names, query_ids = asked["query"].to_numpy(), asked["query_id"].to_numpy()
            vectors = np.stack([np.asarray(v, np.int64) for v in asked["v"]]).reshape(len(asked), row["dims"])
            out += [(int(names[i]), int(query_ids[i]), x, Decimal(max(-MOST, min(MOST, s)))) for i, x, s in search_block(ids, values, query_ids, vectors, k)]
        return pd.DataFrame(out, columns=["query", "query_id", "vec_id", "score"])

    grouped = left.groupBy("block", "group").cogroup(asked.withColumnRenamed("group", "to_group").groupBy("to_block", "to_group"))
    found = grouped.applyInPandas(search, FOUND)
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", F.col("score").try_cast("long").alias("score"))


ORACLE = f"""
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
