"""Importance resampling towards a target distribution, ranked by a distributed LSD radix sort.

Weights: a word run is a feature, its crc32 a bucket. One pass over the texts writes each document's
buckets as an array; the bucket counts of the corpus and of the target give a table of gains, and a
document's weight is the mean of the gains that its array picks. A score adds Gumbel noise from a
hash of the id, so that the highest scores are a draw without replacement.

Ranking: documents that may be drawn are sorted by a composite key (score downward, null ids last, id
upward) digit by digit, the least significant first. Rows have positions 0..n-1 and lie in blocks of
neighbouring positions. A pass counts the digits of each block, sums these counts over digits and
blocks into offsets (where the rows of a block with a digit go), and every block places its own rows:
offset plus the number of rows before it in the block with the same digit. This is stable, so after
the last digit the position is the rank. Blocks are dealt by position, never by key, so equal scores
or repeated ids make no task larger.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footmark.llm.common import cut, prepare, quoted, texts_of

#: Buckets of the features, longest run of words in a feature, least words of a drawn document.
BUCKETS, RUN, LEAST = 10000, 1, 20
#: Share drawn, in percent, and the salt of the noise.
PERCENT, SEED = 10, 2024
#: Bits of one digit; positions of a block at least, and blocks at most (which bounds the counts).
DIGIT_BITS = 12
BLOCK, BLOCKS = 8192, 65536
#: Words whose bucket a task remembers; bytes of a text whose words are held at a time.
CACHE, PIECE = 1 << 18, 1 << 20

# Bytes of UTF-8: A-Z to a-z; 00-2F, 3A-60 and 7B-7F (after that) separate words.
_TABLE = bytes(32 if c <= 0x2F or 0x3A <= c <= 0x40 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F else c + 32 if 0x41 <= c <= 0x5A else c
               for c in range(256))

ROW = "doc_id long, n_features long, weight long, score long"


class _Buckets(dict):
    """feature -> bucket, remembered for a bounded number of features."""

    def __init__(self, buckets):
        self.buckets = buckets

    def __missing__(self, word):
        if len(self) >= CACHE:
            self.clear()
        out = self[word] = zlib.crc32(word) % self.buckets
        return out


def features(text: str, run: int = RUN, piece: int = PIECE) -> Iterator[tuple[int, list[bytes]]]:
    """(words, all runs of 1 to ``run`` consecutive words) of the text, some at a time."""
    data = text.encode("utf-8", "surrogatepass").translate(_TABLE)
    at, tail = 0, []
    while at < len(data):
        end = data.find(b" ", at + piece)
        end = len(data) if end < 0 else end
        new = data[at:end].split()
        out, words = list(new), tail + new
        for k in range(2, run + 1):
            out += [b" ".join(words[i:i + k]) for i in range(max(0, len(tail) - k + 1), len(words) - k + 1)]
        yield len(new), out
        at, tail = end, words[len(words) - min(run - 1, len(words)):]


def _kind(buckets: int):
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def _bucket_batches(batches, buckets, run):
    """(the first columns, number of words, the buckets of the features as an array)."""
    known = _Buckets(buckets)
    for batch in batches:
        n, found = [], []
        for text in texts_of(batch.column(batch.num_columns - 1)):
            parts, count = [], 0
            for words, some in features(text, run):
                count += words
                parts.append(np.fromiter(map(known.__getitem__, some), _kind(buckets), len(some)).tobytes())
            n.append(count)
            found.append(b"".join(parts))
        yield pa.record_batch([*batch.columns[:-1], pa.array(n, pa.int64()), pa.array(found, pa.binary())],
                              names=[*batch.schema.names[:-1], "n_words", "found"])


def _count_batches(batches, buckets):
    """Features in each bucket, a task's sums."""
    total = np.zeros(buckets, dtype=np.int64)
    for batch in batches:
        total += np.bincount(_flat(batch.column(0), buckets)[0], minlength=buckets)
    some = np.flatnonzero(total)
    yield pa.record_batch([pa.array(some), pa.array(total[some])], names=["bucket", "n"])


def _flat(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of arrays, and how many each value has."""
    values, kind = column.to_pylist(), np.dtype(_kind(buckets))
    return np.frombuffer(b"".join(values), dtype=kind), np.array([len(v) // kind.itemsize for v in values], dtype=np.int64)


def _weight_batches(batches, gains):
    for batch in batches:
        flat, n = _flat(batch.column(3), len(gains))
        sums = np.concatenate([[0], np.cumsum(gains[flat])])
        ends = np.cumsum(n)
        total = sums[ends] - sums[ends - n]
        weight = np.where(n > 0, total // np.maximum(n, 1), 0)  # floors go down
        yield pa.record_batch([batch.column(0), batch.column(1), batch.column(2), pa.array(n), pa.array(weight)],
                              names=["uid", "doc_id", "n_words", "n_features", "weight"])


def gain_table(here: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Gain of each bucket from the counts in the corpus and in the target, each count plus one."""
    s, t, n = int(here.sum()), int(there.sum()), len(here)
    return np.array([int(np.floor(1000 * log((float(b) + 1) * (float(s) + n) / ((float(a) + 1) * (float(t) + n)))))
                     for a, b in zip(here, there)], dtype=np.int64)


def _counts(found: DataFrame, buckets: int) -> np.ndarray:
    """Counts by bucket; the driver gets one row a bucket."""
    out = np.zeros(buckets, dtype=np.int64)
    sums = found.mapInArrow(partial(_count_batches, buckets=buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in sums.collect():
        out[r["bucket"]] = r["n"]
    return out


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 * Gumbel) from the first 32 bits of sha256(seed:doc_id)."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10)
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h.cast("double") + 0.5) / F.lit(4294967296.0))))


def weigh(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", *,
          buckets: int = BUCKETS, run: int = RUN, seed: int = SEED) -> DataFrame:
    """One written row per row of ``docs``: uid, doc_id, n_words, n_features, weight, score."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text_col)).cast("string").alias("text"))
    tokens = partial(_bucket_batches, buckets=buckets, run=run)
    found = cut(rows.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")
                .mapInArrow(tokens, "uid long, doc_id long, n_words long, found binary"), "features")
    there = target.select(F.col(quoted(target_col)).cast("string").alias("text")).mapInArrow(tokens, "n_words long, found binary")
    gains = gain_table(_counts(found.select("found"), buckets), _counts(there.select("found"), buckets))
    return cut(found.mapInArrow(partial(_weight_batches, gains=gains), "uid long, doc_id long, n_words long, n_features long, weight long")
               .withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "weights")


def _unsigned(column: pa.Array) -> np.ndarray:
    """Signed 64-bit numbers in the same order as unsigned ones; null is 0."""
    return column.fill_null(-1 << 63).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)


class Field:
    """One part of the composite key: an unsigned number of ``bits`` bits made of a column."""

    def __init__(self, column: str, low: int, high: int, down: bool = False, nulls: bool = False):
        self.column, self.low, self.high, self.down, self.nulls = column, low, high, down, nulls
        self.bits = 1 if nulls else (high - low).bit_length()

    def digits(self) -> list[tuple["Field", int, int]]:
        """(field, shift, bits), the least significant digit first."""
        return [(self, a, min(DIGIT_BITS, self.bits - a)) for a in range(0, self.bits, DIGIT_BITS)]

    def digit(self, column: pa.Array, shift: int, bits: int) -> np.ndarray:
        if self.nulls:
            return (~np.asarray(column.is_valid())).astype(np.int64)
        edge = np.uint64((self.high if self.down else self.low) + (1 << 63))
        v = _unsigned(column)
        v = edge - v if self.down else v - edge
        v = np.where(np.asarray(column.is_valid()), v, np.uint64(0))
        return (v >> np.uint64(shift) & np.uint64((1 << bits) - 1)).astype(np.int64)


def _digit_batches(batches, field, shift, bits):
    for batch in batches:
        yield pa.record_batch([batch.column(0), pa.array(field.digit(batch.column(1), shift, bits))], names=["block", "digit"])


def _place(rows, offsets, field, shift, bits, at, size):
    """The rows of one block at their destinations: a stable counting sort of the block by its digit."""
    rows = rows.combine_chunks()
    order = np.argsort(rows.column("pos").to_numpy(), kind="stable")  # shuffles bring rows in any order
    rows = rows.take(pa.array(order))
    digit = field.digit(rows.column(at).combine_chunks(), shift, bits)
    start = np.zeros(1 << bits, dtype=np.int64)
    start[offsets.column("digit").to_numpy()] = offsets.column("start").to_numpy()
    by_digit = np.argsort(digit, kind="stable")
    count = np.bincount(digit, minlength=1 << bits)
    before = np.cumsum(count) - count
    to = np.empty(len(digit), dtype=np.int64)
    to[by_digit] = np.arange(len(digit)) - before[digit[by_digit]] + start[digit[by_digit]]
    rest = [rows.column(c) for c in rows.column_names if c not in ("block", "pos")]
    return pa.table([pa.array(to // size), pa.array(to), *rest],
                    names=["block", "pos", *[c for c in rows.column_names if c not in ("block", "pos")]])


def radix_sort(rows: DataFrame, fields: list[Field], n: int) -> DataFrame:
    """``rows`` (a written table of block, pos and others; positions ascend within a block and blocks
    ascend) with pos as the rank from 0 by ``fields``, the most significant first. Equal keys keep
    their order. Every pass is written, so a lost executor costs one pass at most."""
    spark = rows.sparkSession
    size = max(BLOCK, -(-n // BLOCKS))
    passes = [d for f in reversed(fields) for d in f.digits()] or [(fields[0], 0, 1)]
    for field, shift, bits in passes:
        seen = rows.select("block", field.column).mapInArrow(partial(_digit_batches, field=field, shift=shift, bits=bits),
                                                            "block long, digit long")
        counts = cut(seen.groupBy("block", "digit").agg(F.count("*").alias("n")), "counts")
        totals = {r["digit"]: r["n"] for r in counts.groupBy("digit").agg(F.sum("n").alias("n")).collect()}  # 2^DIGIT_BITS rows at most
        base, ahead = [], 0
        for d in sorted(totals):
            base.append((d, ahead))
            ahead += totals[d]
        base = spark.createDataFrame(base, "digit long, base long")
        earlier = F.sum("n").over(W.partitionBy("digit").orderBy("block").rowsBetween(W.unboundedPreceding, -1))  # BLOCKS rows at most
        offsets = counts.withColumn("earlier", F.coalesce(earlier, F.lit(0))).join(F.broadcast(base), "digit") \
            .select("block", "digit", (F.col("base") + F.col("earlier")).alias("start"))
        names = [c for c in rows.columns if c not in ("block", "pos")]
        kind = rows.select("block", "pos", *names).schema
        place = partial(_place, field=field, shift=shift, bits=bits, at=field.column, size=size)
        rows = cut(rows.groupBy("block").cogroup(offsets.groupBy("block")).applyInArrow(place, kind), "pass")
    return rows


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", *,
             percent: int = PERCENT, least: int = LEAST, buckets: int = BUCKETS, run: int = RUN, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_features, weight, score, rank.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased; features are all
    runs of 1 to ``run`` words (null and empty texts: none, weight 0). ``rank`` numbers the ``percent``
    percent (rounded down) with the highest scores of the documents that have ``least`` words; ties go
    to the smaller id, null ids last; rows with the same id and score keep the table's order. It is
    null for all others. Repeated rows are documents of their own; long texts are read whole; an empty
    table gives no rows, and an empty target is a target of even counts."""
    rows = weigh(docs, target, id_col, text_col, target_col, buckets=buckets, run=run, seed=seed)
    names = [c.split()[0] for c in ROW.split(", ")]
    able = rows.filter(F.col("n_words") >= least)
    shape = able.agg(F.count("*").alias("n"), F.min("score").alias("s0"), F.max("score").alias("s1"), F.min("doc_id").alias("d0"),
                     F.max("doc_id").alias("d1"), F.count("doc_id").alias("ids")).first()
    n = shape["n"]
    unable = rows.filter(F.col("n_words") < least).select(*names, F.lit(None).cast("long").alias("rank"))
    if not n:
        return unable
    fields = [Field("score", shape["s0"], shape["s1"], down=True)]
    if shape["ids"]:
        fields += [Field("doc_id", 0, 0, nulls=True)] * (shape["ids"] < n) + [Field("doc_id", shape["d0"], shape["d1"])]
    # the first pass takes the blocks in which the rows were written: a task each
    first = able.select(F.shiftright("uid", 33).alias("block"), F.col("uid").alias("pos"), *names)
    rank = F.col("pos") + 1
    return radix_sort(first, fields, n).select(*names, F.when(rank <= n * percent // 100, rank).alias("rank")).unionByName(unable)
