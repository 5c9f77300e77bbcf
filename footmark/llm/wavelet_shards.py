"""Token-id shards as wavelet matrices.

A shard holds the ids of consecutive documents (ascending id) as one bit plane per binary digit,
from the most significant down; after each plane the ids are stably split by that digit. Together
with a rank directory (ones before every 512 bits) this gives access to any position, counting of a
token in any range and the place of its k-th occurrence without decoding the shard.

File format: a folder of parquet files, one compressed file and one row per shard: ``part, shard``
(range partition and number in it), ``base`` (ids before it in the partition), ``n``, ``width``
(planes), ``zeros`` (zeros of each plane), ``planes`` (packed bits, little-endian bit order),
``ranks`` (unsigned 32-bit counts), ``doc_ids`` and ``doc_lengths`` (the documents in order).

Plan: one range shuffle of the texts by id; each task encodes its texts in order, closes a shard
every SHARD_IDS ids and writes it. Reading is a map over the files; only the ids per partition (one
number each) pass through the driver to give the global starts.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footmark.llm.bpe import encoder
from footmark.llm.common import new_path, partitions, prepare, texts_of

END_ID = 2
#: A shard is closed with the document that brings it to so many ids.
SHARD_IDS = 1 << 20
BLOCK_BITS = 512

SCHEMA = ("part long, shard long, base long, n long, width int, zeros array<long>, planes array<binary>, "
          "ranks array<binary>, doc_ids array<long>, doc_lengths array<long>")


class WaveletMatrix:
    """Succinct sequence of ids: access, rank and select on bit planes."""

    def __init__(self, n: int, width: int, zeros: list[int], planes: list[bytes], ranks: list[bytes]):
        self.n, self.width, self.zeros = n, width, zeros
        self.planes = [np.frombuffer(p, dtype=np.uint8) for p in planes]
        self.ranks = [np.frombuffer(r, dtype=np.uint32) for r in ranks]

    @classmethod
    def build(cls, ids: np.ndarray) -> "WaveletMatrix":
        width = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        zeros, planes, ranks = [], [], []
        for level in range(width - 1, -1, -1):
            bit = (ids >> level) & 1 == 1
            packed = np.packbits(bit, bitorder="little")
            padded = np.zeros(-(-len(packed) // 64) * 64, dtype=np.uint8)
            padded[:len(packed)] = packed
            ones = np.bitwise_count(padded.view(np.uint64)).reshape(-1, 8).sum(axis=1)
            planes.append(packed.tobytes())
            ranks.append(np.concatenate([[0], np.cumsum(ones)]).astype(np.uint32).tobytes())
            low = ids.take(np.flatnonzero(~bit))  # much faster than a boolean mask on random bits
            zeros.append(len(low))
            ids = np.concatenate([low, ids.take(np.flatnonzero(bit))])
        return cls(sum(zeros[:1]) + int(np.frombuffer(ranks[0], dtype=np.uint32)[-1]), width, zeros, planes, ranks)

    def _ones(self, level: int, at: int) -> int:
        """Ones of a plane before position ``at``."""
        block = at // BLOCK_BITS
        first = block * (BLOCK_BITS // 8)
        some = self.planes[level][first:at // 8]
        ones = int(self.ranks[level][block]) + int(np.bitwise_count(some).sum())
        if at % 8:
            ones += (int(self.planes[level][at // 8]) & ((1 << at % 8) - 1)).bit_count()
        return ones

    def access(self, i: int) -> int:
        value = 0
        for level in range(self.width):
            bit = int(self.planes[level][i // 8]) >> (i % 8) & 1
            value = value << 1 | bit
            ones = self._ones(level, i)
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def rank(self, token: int, i: int) -> int:
        """Occurrences of ``token`` before position ``i``."""
        if token >> self.width:
            return 0
        lo, hi = 0, i
        for level in range(self.width):
            a, b = self._ones(level, lo), self._ones(level, hi)
            if token >> (self.width - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return hi - lo

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        return self.rank(token, self.n if end is None else end) - self.rank(token, start)

    def select(self, token: int, k: int) -> int:
        """Position of the ``k``-th (from 0) occurrence of ``token``; -1 if there are fewer."""
        if k >= self.count(token):
            return -1
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            if self.rank(token, mid + 1) <= k:
                lo = mid + 1
            else:
                hi = mid
        return lo

    def decode(self) -> np.ndarray:
        """All ids, from the last plane up (each plane undoes one stable split)."""
        kind = np.uint16 if self.width <= 16 else np.uint32
        value = np.zeros(self.n, dtype=kind)
        for level in range(self.width - 1, -1, -1):
            bit = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            up = np.empty_like(value)
            up[np.flatnonzero(~bit)] = value[:self.zeros[level]]
            up[np.flatnonzero(bit)] = value[self.zeros[level]:] | kind(1 << (self.width - 1 - level))
            value = up
        return value


def _shard_batches(batches, tokenizer, end_id, shard_ids):
    enc = encoder(tokenizer)
    part, shard, base = None, 0, 0
    docs: list = []
    lengths: list[int] = []
    held: list[np.ndarray] = []

    def close():
        nonlocal shard, base
        w = WaveletMatrix.build(np.concatenate(held))
        row = {"part": part, "shard": shard, "base": base, "n": w.n, "width": w.width, "zeros": w.zeros,
               "planes": [p.tobytes() for p in w.planes], "ranks": [r.tobytes() for r in w.ranks],
               "doc_ids": list(docs), "doc_lengths": list(lengths)}
        shard, base = shard + 1, base + w.n
        docs.clear(), lengths.clear(), held.clear()
        big = pa.list_(pa.binary())
        kinds = {"part": pa.int64(), "shard": pa.int64(), "base": pa.int64(), "n": pa.int64(), "width": pa.int32(),
                 "zeros": pa.list_(pa.int64()), "planes": big, "ranks": big, "doc_ids": pa.list_(pa.int64()),
                 "doc_lengths": pa.list_(pa.int64())}
        return pa.record_batch([pa.array([row[k]], t) for k, t in kinds.items()], names=list(kinds))

    size = 0
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), texts_of(batch.column(1))
        if len(ids):
            part = batch.column(2)[0].as_py()
        for lo, _, got, starts in enc.batches(texts):
            end = np.array([end_id], dtype=got.dtype)
            for i, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
                docs.append(ids[lo + i])
                lengths.append(int(b - a) + 1)
                held += [got[a:b], end]
                size += lengths[-1]
                if size >= shard_ids:
                    yield close()
                    size = 0
    if docs:
        yield close()


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *, end_id: int = END_ID,
                 tokenizer: str | None = None, shard_ids: int = SHARD_IDS) -> None:
    """Encode all texts and write the shards below ``path`` in ascending id order.

    Null and empty texts are the end id alone; null ids come first; repeated ids and rows follow one
    another; a text is never cut, so a very long one makes a longer shard; an empty table writes no
    shard. ``tokenizer`` is a file that every executor has."""
    spark = docs.sparkSession
    prepare(spark)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      F.monotonically_increasing_id().alias("uid"))
    rows = src.repartitionByRange(partitions(spark), "doc_id", "uid").sortWithinPartitions("doc_id", "uid") \
        .select("doc_id", "text", F.spark_partition_id().cast("long").alias("part"))
    rows.mapInArrow(partial(_shard_batches, tokenizer=tokenizer, end_id=end_id, shard_ids=shard_ids), SCHEMA) \
        .write.option("compression", "zstd").option("maxRecordsPerFile", 1).parquet(path)


def _digest_batches(batches):
    names = ["part", "doc_id", "begin", "n_tokens", "ids_crc32"]
    for batch in batches:
        for i in range(batch.num_rows):
            part, _, base, n, width, zeros, planes, ranks, doc_ids, lengths = (c[i].as_py() for c in batch.columns)
            ids = WaveletMatrix(n, width, zeros, planes, ranks).decode().astype(np.uint32)
            lengths = np.array(lengths, dtype=np.int64)
            ends = np.cumsum(lengths)
            crc = [zlib.crc32(ids[e - k:e]) for e, k in zip(ends, lengths)]
            yield pa.record_batch([pa.array(np.full(len(crc), part)), pa.array(doc_ids, pa.int64()),
                                   pa.array(ends - lengths + base), pa.array(lengths), pa.array(crc, pa.int64())], names=names)


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    prepare(spark)
    shards = spark.read.schema(SCHEMA).parquet(path)
    ahead, total = [], 0
    for r in shards.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():  # a row a range partition
        ahead.append((r["part"], total))
        total += r["n"]
    ahead = spark.createDataFrame(ahead, "part long, ahead long")
    docs = shards.mapInArrow(_digest_batches, "part long, doc_id long, begin long, n_tokens long, ids_crc32 long")
    return docs.join(ahead, "part").select("doc_id", (F.col("begin") + F.col("ahead")).alias("start"), "n_tokens", "ids_crc32")


def token_table(docs: DataFrame, **how) -> DataFrame:
    """Write the shards to a new folder below the checkpoint folder and read their digest."""
    spark = docs.sparkSession
    path = new_path(spark, "wavelet")
    write_shards(docs, path + "/shards", **how)
    return read_digest(spark, path + "/shards")
