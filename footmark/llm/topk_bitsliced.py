"""Exact top-k inner-product search with a bit-sliced index.

The index keeps blocks of rows. In a block each attribute (a component as integer) is quantised to
its upper bits, and each of these bits is one bitmap over the rows. For a query the weighted slices
are added with bitmap arithmetic (carry-save adders; slices of attributes with a negative weight are
complemented), which gives the slices of an approximate score for all rows at once. The k-th best
approximate score is found from the most significant slice downward; every row that the dropped
bits could still lift to it is a boundary row, and the boundary rows are resolved exactly from the
integers. So the result is exact; quantisation only sets how many rows are resolved.

Vectors with components too large for 64-bit sums lie in blocks of their own, without slices. Pairs
of blocks with such a side are scored exactly from all rows: with 64-bit integers where the query's
sum of magnitudes times the block's largest one allows it, else with Python's.

Plan: index blocks and query blocks are made by a map over the rows (no shuffle); each pair of an
index and a query block is one row of work (query blocks travel, they are the small side), its
result at most k rows a query; a window over (blocks x k) rows a query ends it. Index blocks are dealt
by number over a fixed count of tasks, since work, not bytes, is what a block costs.
"""

from __future__ import annotations

from fractions import Fraction
from functools import partial
from math import floor, isfinite, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footmark.llm.common import cut, partitions, prepare
from footmark.llm.vectors import matrices

SCALE = 1024
#: Rows of an index block, queries of a query block, bits that quantisation keeps of an attribute.
ROWS, QUERIES, KEEP_BITS = 16384, 256, 8
#: Integers below it go into sliced blocks (and below what keeps a sum of products under 2^62).
SLICED = 1 << 26
#: Rows of a block of larger integers.
LARGE_ROWS = 1024


def _block_batches(batches, scale, rows, every):
    """Blocks of (ids, components); ``every``: only ids divisible by it. Sliced blocks hold 32-bit
    integers, others the components as doubles."""
    held: dict[tuple[int, bool], list] = {}

    def block(kind):
        d, sliced = kind
        ids, values = (np.concatenate(x) for x in zip(*held.pop(kind)))
        most = rows if sliced else min(rows, LARGE_ROWS)
        for a in range(0, len(ids), most):
            yield pa.record_batch([pa.array([d], pa.int32()), pa.array([sliced]), pa.array([ids[a:a + most].tobytes()], pa.binary()),
                                   pa.array([np.ascontiguousarray(values[a:a + most]).tobytes()], pa.binary())],
                                  names=["dim", "sliced", "ids", "vals"])

    for batch in batches:
        ids = batch.column(0)
        has = np.array(ids.is_valid())
        ids = ids.fill_null(-1).to_numpy()
        if every:
            has &= ids % every == 0
        for at, m in matrices(batch.column(1)):
            d = m.shape[1]
            with np.errstate(over="ignore"):
                v = np.floor(scale * m)
            small = np.abs(v).max(axis=1) < min(SLICED, isqrt((1 << 62) // d))
            for sliced, some in ((True, has[at] & small), (False, has[at] & ~small)):
                if some.any():
                    kind = (d, sliced)
                    held.setdefault(kind, []).append((ids[at[some]], v[some].astype(np.int32) if sliced else m[some]))
                    if sum(len(x[0]) for x in held[kind]) >= (rows if sliced else LARGE_ROWS):
                        yield from block(kind)
    for kind in list(held):
        yield from block(kind)


def integers(vals: bytes, d: int, sliced: bool, scale: int) -> np.ndarray:
    """The integers of a block: 64-bit if sliced, else Python's, exact for any double."""
    if sliced:
        return np.frombuffer(vals, dtype=np.int32).reshape(-1, d).astype(np.int64)
    flat = [floor(scale * x) if isfinite(scale * x) else floor(scale * Fraction(x)) for x in np.frombuffer(vals, dtype=np.float64).tolist()]
    out = np.empty(len(flat), dtype=object)
    out[:] = flat
    return out.reshape(-1, d)


def scan(ids: np.ndarray, values: np.ndarray, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, list[int]]:
    """The k best (ids, scores) of a block by scoring every row; as ``BitSlices.search`` otherwise."""
    wide = sum(map(abs, q.tolist())) * int(np.abs(values).max()) >= 1 << 63
    kind = object if wide else np.int64
    score = (values.astype(kind) * q.astype(kind)).sum(axis=1).tolist()
    best: dict[int, int] = {}
    for i, s in zip(ids.tolist(), score):
        if i != own and s > best.get(i, s - 1):
            best[i] = s
    top = sorted(best, key=lambda i: (-best[i], i))[:k]
    return np.array(top, dtype=np.int64), [best[i] for i in top]


class BitSlices:
    """The bit-sliced index of one block: ids (n) and integers (n x d)."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, keep_bits: int = KEEP_BITS):
        self.ids, self.values = ids, values
        n, d = values.shape
        low = values.min(axis=0).astype(np.int64)
        span = int((values.max(axis=0) - low).max())
        self.shift = max(0, span.bit_length() - keep_bits)
        self.bits = max(1, span.bit_length() - self.shift)
        up = (values - low) >> self.shift
        words = -(-n // 64)
        packed = np.zeros((d, self.bits, words * 8), dtype=np.uint8)
        for j in range(self.bits):
            packed[:, j, :-(-n // 8)] = np.packbits((up >> j & 1).T.astype(bool), axis=1, bitorder="little")
        self.slices = packed.view(np.uint64)                      # attribute, bit, word
        self.valid = self.pack(np.ones(n, dtype=bool))

    def pack(self, mask: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.slices[0, 0]) * 8, dtype=np.uint8)
        packed = np.packbits(mask, bitorder="little")
        out[:len(packed)] = packed
        return out.view(np.uint64)

    def scores(self, q: np.ndarray) -> list[np.ndarray]:
        """Slices, least significant first, of sum |q_d| * u_d, where u_d is the attribute's upper
        part, counted downward from its largest value where q_d is negative."""
        weight = np.abs(q)
        planes = np.where((q < 0)[:, None, None], ~self.slices, self.slices)
        top = int(weight.max()).bit_length() + self.bits
        columns: list[list[np.ndarray]] = [[] for _ in range(top + 1)]
        for i in range(int(weight.max()).bit_length()):
            dims = np.flatnonzero(weight >> i & 1)
            if len(dims):
                some = planes[dims]
                for j in range(self.bits):
                    columns[i + j].append(some[:, j])
        out, c = [], 0
        while c < len(columns):
            x = np.concatenate(columns[c]) if columns[c] else np.zeros((1, self.slices.shape[2]), dtype=np.uint64)
            if len(x) > 1 and c + 1 == len(columns):
                columns.append([])
            while len(x) > 1:
                k = len(x) // 3
                if k:
                    a, b, e = x[:k], x[k:2 * k], x[2 * k:3 * k]
                    ab = a ^ b
                    carry = (a & b) | (ab & e)
                    x = np.concatenate([ab ^ e, x[3 * k:]])
                else:
                    carry = x[:1] & x[1:]
                    x = x[:1] ^ x[1:]
                columns[c + 1].append(carry)
            out.append(x[0])
            c += 1
        return out

    def search(self, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best (ids, scores) of this block; the best score of an id that repeats; ties to
        smaller ids; ``own`` is left out."""
        q = q.astype(np.int64)
        valid = self.valid
        mine = self.ids == own
        if mine.any():
            valid = valid & ~self.pack(mine)
        slices = self.scores(q) if len(q) and q.any() else []
        # what the dropped bits can add, in units of the kept bits
        slack = -(-int(np.abs(q).sum()) * ((1 << self.shift) - 1) >> self.shift)
        want = k
        while True:
            rows = np.flatnonzero(np.unpackbits(self._boundary(slices, valid, want, slack).view(np.uint8),
                                                bitorder="little", count=len(self.ids)))
            score = self.values[rows].astype(np.int64) @ q
            order = np.lexsort((self.ids[rows], -score))
            ids, score = self.ids[rows][order], score[order]
            first = np.sort(np.unique(ids, return_index=True)[1])
            if len(first) >= k or len(rows) == int(np.bitwise_count(valid).sum()):
                return ids[first[:k]], score[first[:k]]
            want *= 4

    def _boundary(self, slices, valid, k, slack):
        """Bitmap of the rows that may be among the k best."""
        if int(np.bitwise_count(valid).sum()) <= k:
            return valid
        above, equal, kth = np.zeros_like(valid), valid, 0
        for level in range(len(slices) - 1, -1, -1):
            ones = equal & slices[level]
            if int(np.bitwise_count(above | ones).sum()) >= k:
                equal, kth = ones, kth | 1 << level
            else:
                above, equal = above | ones, equal & ~slices[level]
        least = kth - slack
        if least <= 0:
            return valid
        above, equal = np.zeros_like(valid), valid
        for level in range(len(slices) - 1, -1, -1):
            if least >> level & 1:
                equal = equal & slices[level]
            else:
                above, equal = above | (equal & slices[level]), equal & ~slices[level]
        return above | equal


def _search_batches(batches, k, scale):
    at, index = None, None
    for batch in batches:
        for i, dim, sliced, ids, vals, q_sliced, q_ids, q_vals in zip(*(c.to_pylist() for c in batch.columns)):
            if (i, q_sliced) != at:
                at, numbers = (i, q_sliced), np.frombuffer(ids, dtype=np.int64)
                index = BitSlices(numbers, np.frombuffer(vals, dtype=np.int32).reshape(-1, dim)) if sliced and q_sliced \
                    else integers(vals, dim, sliced, scale)
            out = [[], [], []]
            for own, q in zip(np.frombuffer(q_ids, dtype=np.int64), integers(q_vals, dim, q_sliced, scale)):
                found, score = index.search(q, own, k) if sliced and q_sliced else scan(numbers, index, q, own, k)
                out[0] += [own] * len(found)
                out[1] += found.tolist()
                out[2] += [s if s >= -1 << 63 else None for s in score]  # null: below every long
            # a score above every long is an error here: it is among the k best, or k such scores are
            yield pa.record_batch([pa.array(x, pa.int64()) for x in out], names=["query_id", "vec_id", "score"])


def _numbered(blocks: DataFrame) -> tuple[DataFrame, int]:
    """Written blocks with numbers from 0 in place of their ids; the driver sees a row a partition."""
    spark = blocks.sparkSession
    counts = blocks.groupBy(F.shiftright("id", 33).alias("p")).agg(F.count("*").alias("c")).orderBy("p").collect()
    ahead, total = [], 0
    for r in counts:
        ahead.append((r["p"], total))
        total += r["c"]
    ahead = F.broadcast(spark.createDataFrame(ahead, "p long, ahead long"))
    return blocks.join(ahead, F.shiftright("id", 33) == F.col("p")) \
        .withColumn("q", F.col("ahead") + F.col("id").bitwiseAND(F.lit((1 << 33) - 1))).drop("p", "ahead", "id"), total


def top_k(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, every: int = 100, k: int = 10,
          scale: int = SCALE) -> DataFrame:
    """For each row whose id is divisible by ``every``: its k best other rows by the inner product of
    floor(scale * component): query_id, rank (from 1), vec_id, score.

    Vectors that are null, empty or hold null or non-finite components, and rows with a null id, take
    no part; vectors of different lengths aren't compared. Finite components of any size count
    exactly; if one of a query's k best scores doesn't fit a long, the query fails. Ties go to the
    smaller id. Rows that share an id count once in a query's list, with their best score, and aren't
    candidates of that id's queries; a query id that repeats has one list. An empty table gives no
    rows."""
    spark = rows.sparkSession
    prepare(spark)
    src = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    kind = "dim int, sliced boolean, ids binary, vals binary"
    index = cut(src.mapInArrow(partial(_block_batches, scale=scale, rows=ROWS, every=0), kind)
                .withColumn("i", F.monotonically_increasing_id()), "index")
    asked, n = _numbered(cut(src.mapInArrow(partial(_block_batches, scale=scale, rows=QUERIES, every=every), kind)
                             .withColumn("id", F.monotonically_increasing_id()), "queries"))
    asked = asked.select("q", F.col("dim").alias("q_dim"), F.col("sliced").alias("q_sliced"), F.col("ids").alias("q_ids"), F.col("vals").alias("q_vals"))
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    work = index.select("i", "dim", F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>")).alias("q"))
    work = work.join(asked, "q").filter("dim = q_dim").select("i", "q_sliced", "q_ids", "q_vals")
    work = work.join(index.repartition(partitions(spark), "i").hint("merge"), "i") \
        .select("i", "dim", "sliced", "ids", "vals", "q_sliced", "q_ids", "q_vals")
    found = work.mapInArrow(partial(_search_batches, k=k, scale=scale), "query_id long, vec_id long, score long")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc_nulls_last("score"), "vec_id"))
    score = F.coalesce("score", F.raise_error(F.lit("a score among the best doesn't fit a long")))
    return best.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", score.alias("score"))
