"""Packing into fixed-length sequences along a space-filling curve.

A document's token ids are hashed into a vector, projected to a few dimensions and mapped to its
place on a Hilbert curve. Documents are range-sorted by that key and laid end to end, so that
neighbours on the curve share sequences; each range partition cuts its row of ids into full
sequences and its rest into sequences whose lengths are powers of two, so nothing is padded.

Plan: one pass tokenises and writes (key, ids) in rows of at most ROW_IDS ids; one range shuffle by
(key, id, row) moves the ids; packing is a single streaming pass over each partition. The ranges are
cut by rows, so a long document weighs as much as its ids and may lie across ranges. Equal keys are
split by id and row, so a large group of copies spreads over as many partitions as its size needs.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footmark.llm.bpe import encoder
from footmark.llm.common import cut, mix, partitions, prepare, texts_of

LENGTH = 2048
END_ID = 1
#: Ids of one row of the range shuffle, at most.
ROW_IDS = 256
#: Buckets of the hashed vectors, dimensions of the projection, bits of a coordinate.
BUCKETS, DIMS, BITS = 4096, 4, 10


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index on the Hilbert curve of each row of integer coordinates (Skilling's transform)."""
    x = points.astype(np.int64).T.copy()
    d = len(x)
    for level in range(bits - 1, 0, -1):
        q, low = 1 << level, (1 << level) - 1
        for i in range(d):
            flip = (x[i] & q) > 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        t ^= np.where((x[-1] >> level) & 1, (1 << level) - 1, 0)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | (((x[i] ^ t) >> level) & 1)
    return key


def _projection() -> np.ndarray:
    return np.random.default_rng(7).standard_normal((BUCKETS, DIMS)).astype(np.float32)


def curve_keys(ids: np.ndarray, starts: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Curve key of each document (its ids run from its start to the next)."""
    n = np.diff(starts)
    if not len(n):
        return np.zeros(0, dtype=np.int64)
    bucket = (mix(ids.astype(np.uint64)) >> np.uint64(32)) % np.uint64(BUCKETS)
    total = np.zeros((len(n), DIMS))
    full = n > 0
    if full.any():
        total[full] = np.add.reduceat(projection[bucket], starts[:-1][full], axis=0)
    mean = total / np.maximum(n, 1)[:, None]
    return hilbert_key(np.floor((np.tanh(2 * mean) + 1) / 2 * ((1 << BITS) - 1)), BITS)


def _encode_batches(batches, tokenizer, end_id):
    enc, projection = encoder(tokenizer), _projection()
    for batch in batches:
        texts = texts_of(batch.column(1))
        for lo, hi, ids, starts in enc.batches(texts):
            end = np.array([end_id], dtype=ids.dtype)
            docs = [np.concatenate([ids[a:b], end]) for a, b in zip(starts[:-1], starts[1:])]
            total = np.array([len(d) for d in docs], dtype=np.int64)
            count = -(-total // ROW_IDS)
            of = np.repeat(np.arange(hi - lo), count)
            first = (np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)) * ROW_IDS
            rows = [docs[d][f:f + ROW_IDS].tobytes() for d, f in zip(of, first)]
            yield pa.record_batch([batch.column(0).slice(lo, hi - lo).take(pa.array(of)), pa.array(curve_keys(ids, starts, projection)[of]),
                                   pa.array([enc.dtype().itemsize] * len(of), pa.int32()), pa.array(rows, pa.binary()),
                                   pa.array(first), pa.array(total[of])], names=["doc_id", "key", "width", "ids", "first", "total"])


def _pack_batches(batches, length):
    state = {"seq": 0}
    out: list[tuple] = []

    def close(pieces, size):
        """One sequence of the open pieces, or, at the end, one for each binary digit of their size."""
        at = 0
        pieces = list(pieces)
        for digit in ([size] if size == length else [1 << b for b in range(size.bit_length() - 1, -1, -1) if size >> b & 1]):
            fill = 0
            while fill < digit:
                doc, start, ids, n, part = pieces[at]
                take = min(digit - fill, len(ids))
                out.append((doc, start, take, ids[:take].astype(np.uint32).tobytes(), n, (part << 33) + state["seq"], fill))
                fill += take
                if take < len(ids):
                    pieces[at] = (doc, start + take, ids[take:], n, part)
                else:
                    at += 1
            state["seq"] += 1

    def flush():
        cols = list(zip(*out))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        names = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
        batch = pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)
        out.clear()
        return batch

    opened, fill = [], 0
    for batch in batches:
        for doc, width, raw, first, total, part in zip(*(c.to_pylist() for c in batch.columns)):
            ids = np.frombuffer(raw, dtype=np.uint16 if width == 2 else np.uint32)
            at = 0
            while at < len(ids):
                take = min(length - fill, len(ids) - at)
                got = ids[at:at + take]
                if first and not at and opened:  # the document's row before this one ends the open sequence
                    _, start, held, _, _ = opened[-1]
                    opened[-1] = (doc, start, np.concatenate([held, got]), total, part)
                else:
                    opened.append((doc, first + at, got, total, part))
                at, fill = at + take, fill + take
                if fill == length:
                    close(opened, fill)
                    opened, fill = [], 0
            if len(out) >= 2000:
                yield flush()
    if fill:
        close(opened, fill)
    if out:
        yield flush()


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length: int = LENGTH,
         end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset. Every id lies in exactly one piece; a sequence has ``length`` ids, or a
    power of two at the end of a partition.

    Null and empty texts are the end id alone; repeated rows and null ids are documents of their
    own; ties on the curve are ordered by id, then by row; an empty table gives no rows; a text of
    any length is cut into as many pieces as it needs. ``tokenizer`` is a file that every executor
    has (default: the public vocabulary installed with the tokenizers)."""
    spark = docs.sparkSession
    prepare(spark)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    tokens = src.mapInArrow(partial(_encode_batches, tokenizer=tokenizer, end_id=end_id),
                            "doc_id long, key long, width int, ids binary, first long, total long")
    tokens = cut(tokens.withColumn("uid", F.monotonically_increasing_id()), "tokens")
    return tokens.repartitionByRange(partitions(spark), "key", "doc_id", "uid") \
        .sortWithinPartitions("key", "doc_id", "uid") \
        .select("doc_id", "width", "ids", "first", "total", F.spark_partition_id().cast("long").alias("part")) \
        .mapInArrow(partial(_pack_batches, length=length),
                    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
