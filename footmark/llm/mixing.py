"""Mixing sources to target weights by blocks.

The words of a source, its documents laid end to end in id order, are cut into blocks of BLOCK words,
however large the source is: what a document may lose or repeat doesn't depend on the input's size.
The mix is a row of slots in output shards. Each shard draws how many of its slots go to each
source: the whole parts of the expected counts are fixed and the rest is a multinomial draw, so the
draw is multinomial per shard with little variance. A source's j-th slot takes the block at index
perm(j mod n) of pass j div n, a keyed pseudorandom permutation of its n blocks; then blocks are
joined by index. Every pass takes each block once, so nothing is taken more than three times.

The driver sees one row a source and one row a range partition; documents, blocks and slots stay
distributed. A hot source is split by ranges of (source, id), and its blocks are separate join keys.
Blocks, slots and shards grow in proportion to the words; a shard has SLOTS slots.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footmark.llm.common import (chunks, codepoints, columns_of, cut, mix, numbered, partitions, prepare, quoted, texts_of,
                                 word_starts)

#: Words of a block, block numbers in one Arrow batch at most, slots of an output shard, times a word may be taken.
BLOCK = 32
BLOCKS = 1 << 16
SLOTS = 16384
CAP = 3
#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
SEED = 20240611


def targets(sizes: dict[str | None, int], weights=WEIGHTS, cap: int = CAP) -> dict[str | None, float]:
    """Shares of the total by weight; what is above ``cap`` times a source's size is reshared."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out: dict[str | None, float] = {}
    rest, free = float(sum(sizes.values())), list(order)
    while free:
        total = sum(weight[s] for s in free)
        share = {s: rest * weight[s] / total for s in free}
        above = [s for s in free if share[s] > cap * sizes[s]]
        if not above:
            return out | share
        for s in above:
            out[s] = float(cap * sizes[s])
            rest -= out[s]
        free = [s for s in free if s not in above]
    return out


def shard_counts(shard: int, slots: int, p: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Slots of each source in one output shard."""
    expected = slots * p
    whole = np.floor(expected + 1e-9)
    frac = np.maximum(expected - whole, 0)
    left = int(slots - whole.sum())
    if left > 0 and frac.sum() > 0:
        whole = whole + np.random.default_rng([seed, shard]).multinomial(left, frac / frac.sum())
    return whole.astype(np.int64)


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1: a four-round Feistel network, walked until it is below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)

    def once(x):
        a, b = x >> np.uint64(half), x & mask
        for r in range(4):
            a, b = b, a ^ (mix(b, key * 8 + r) & mask)
        return (a << np.uint64(half)) | b

    x = once(index.astype(np.uint64))
    while (out := x >= n).any():
        x[out] = once(x[out])
    return x.astype(np.int64)


def _size_batches(batches):
    for batch in batches:
        texts = texts_of(batch.column(3))
        n = np.zeros(len(texts), dtype=np.int64)
        for lo, hi in chunks(texts):
            _, cp, off = codepoints(texts[lo:hi])
            n[lo:hi] = np.diff(word_starts(cp, off)[2])
        yield pa.record_batch([*batch.columns[:3], pa.array(n)], names=["uid", "doc_id", "source", "size"])


def _lay_batches(batches):
    """Rows in (source, id) order: where each starts among this partition's rows of its source."""
    last, total = None, 0
    for batch in batches:
        src, size = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        ends = np.cumsum(size)
        begin = ends - size
        new = np.flatnonzero(np.append(len(src) > 0 and src[0] != last, src[1:] != src[:-1])) if len(src) else []
        base = np.full(len(src), -total, dtype=np.int64)
        for a in new:
            base[a:] = begin[a]
        if len(src):
            total = int(ends[-1] - base[-1])
            last = src[-1]
        yield pa.record_batch([*batch.columns, pa.array(begin - base)], names=[*batch.schema.names, "begin"])


def _draw_batches(batches, p, slots, total):
    for batch in batches:
        for shard in batch.column(0).to_pylist():
            k = shard_counts(shard, min(slots, total - shard * slots), p)
            some = np.flatnonzero(k)
            yield pa.record_batch([pa.array(np.full(len(some), shard)), pa.array(some), pa.array(k[some])], names=["shard", "sid", "k"])


def _slot_batches(batches, blocks, seed, cap, step):
    for batch in batches:
        for sid, first, k in zip(*(c.to_pylist() for c in batch.columns)):
            n = int(blocks[sid])
            end = min(first + k, cap * n)
            for lo in range(first, end, step):
                j = np.arange(lo, min(lo + step, end))
                at = np.empty(len(j), dtype=np.int64)
                for turn in range(cap):
                    m = j // n == turn
                    if m.any():
                        at[m] = permuted(j[m] % n, n, (seed * 1000003 + sid) * cap + turn)
                yield pa.record_batch([pa.array(np.full(len(at), sid)), pa.array(at)], names=["sid", "block"])


def lay_out(rows: DataFrame, weights=WEIGHTS, cap: int = CAP, block: int = BLOCK, seed: int = SEED):
    """From rows (uid, doc_id, source, text): (one row per document with its source's figures, and
    one row per document and block with its words there and how often the mix takes the block)."""
    spark = rows.sparkSession
    sized = cut(rows.select("uid", F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                            F.col("text").cast("string").alias("text"))
                .mapInArrow(_size_batches, "uid long, doc_id long, source string, size long"), "sizes")
    sizes = {r["source"]: r["size"] for r in sized.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    goal = targets(sizes, weights, cap)
    order = list(goal)
    table = spark.createDataFrame([(i, s, sizes[s], goal[s]) for i, s in enumerate(order)],
                                  "sid long, s string, source_size long, target double")
    docs = cut(sized.join(table, F.col("source").eqNullSafe(F.col("s")), "left")
               .select("uid", "doc_id", "size", "sid", "source_size", "target"), "by_source")
    blocks = np.array([-(-sizes[s] // block) for s in order], dtype=np.int64)
    want = np.array([goal[s] * b / sizes[s] if sizes[s] else 0.0 for s, b in zip(order, blocks)])
    total = int(round(want.sum()))
    p = want / want.sum() if total else want
    shards = -(-total // SLOTS)
    # lay the documents of each source end to end
    laid = cut(docs.filter("size > 0").repartitionByRange(partitions(spark), "sid", "doc_id", "size", "uid")
               .sortWithinPartitions("sid", "doc_id", "size", "uid")
               .select("uid", "sid", "size", F.spark_partition_id().cast("long").alias("part"))
               .mapInArrow(_lay_batches, "uid long, sid long, size long, part long, begin long"), "laid")
    sums = laid.groupBy("part", "sid").agg(F.sum("size").alias("n")).collect()  # at most partitions + sources rows
    done: dict[int, int] = {}
    ahead = []
    for r in sorted(sums, key=lambda r: (r["part"], r["sid"])):
        ahead.append((r["part"], r["sid"], done.get(r["sid"], 0)))
        done[r["sid"]] = done.get(r["sid"], 0) + r["n"]
    ahead = spark.createDataFrame(ahead, "part long, sid long, ahead long")
    placed = laid.join(ahead, ["part", "sid"]).withColumn("begin", F.col("begin") + F.col("ahead"))
    begin, size = F.col("begin"), F.col("size")
    at = F.explode(F.sequence(F.floor(begin / block), F.floor((begin + size - 1) / block)))
    pieces = placed.select("uid", "sid", "begin", "size", at.alias("block")) \
        .select("uid", "sid", "block", F.greatest(F.lit(0), F.col("block") * block - begin).alias("first"),
                (F.least(begin + size, (F.col("block") + 1) * block) - F.greatest(begin, F.col("block") * block)).alias("words"))
    # the slots of all shards
    drawn = spark.range(shards).mapInArrow(partial(_draw_batches, p=p, slots=SLOTS, total=total), "shard long, sid long, k long")
    before = F.sum("k").over(W.partitionBy("sid").orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    taken = drawn.select("sid", "k", F.coalesce(before, F.lit(0)).alias("first")).filter("k > 0") \
        .select("sid", "first", "k").repartition(partitions(spark)) \
        .mapInArrow(partial(_slot_batches, blocks=blocks, seed=seed, cap=cap, step=BLOCKS), "sid long, block long") \
        .groupBy("sid", "block").agg(F.count("*").alias("times"))
    # without the hint the planner takes the slots, whose number it can't know, for a small table
    return docs, pieces.join(taken.hint("merge"), ["sid", "block"])


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                weights=WEIGHTS, cap: int = CAP, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken.

    size: words of the text (null and empty: 0, never taken); null sources are one source, the last;
    repeated rows and null ids are documents of their own (null ids lie first in their source);
    target: the source's share; taken: words that the mix takes, repeats counted, at most ``cap``
    times the size. An empty table gives no rows. Reruns over the same files agree."""
    prepare(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("doc_id"),
                       F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    by_doc, pieces = lay_out(rows, weights, cap, block, seed)
    taken = pieces.groupBy("uid").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    return by_doc.join(taken, "uid", "left") \
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def _pass_texts(text: str, runs: list[dict]) -> list[str]:
    """The words that each pass takes of a text: all of it unchanged, or the taken runs, one a line."""
    _, cp, off = codepoints([text])
    at = np.append(word_starts(cp, off)[1], len(text))
    out = []
    for k in range(max(r["times"] for r in runs)):
        parts, last = [], None
        for r in sorted((r for r in runs if r["times"] > k), key=lambda r: r["first"]):
            if last == r["first"]:
                parts[-1][1] = r["first"] + r["words"]
            else:
                parts.append([r["first"], r["first"] + r["words"]])
            last = r["first"] + r["words"]
        whole = len(parts) == 1 and parts[0] == [0, len(at) - 1]
        out.append(text if whole else "\n".join(text[at[a]:at[b]].rstrip("\t\n\x0b\x0c\r ") for a, b in parts))
    return out


def _mix_batches(batches, at, length):
    """Rows (their columns, then runs): one for each pass, with its words as column ``at``."""
    for batch in batches:
        rows, texts = [], []
        for i, (text, runs) in enumerate(zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())):
            new = _pass_texts(text, runs)
            rows += [i] * len(new)
            texts += new
        out = [c.take(pa.array(rows, pa.int64())) for c in batch.columns[:-1]]
        out[at] = pa.array(texts, pa.string())
        if length is not None:
            out[length] = pa.array([len(t) for t in texts]).cast(out[length].type)
        yield pa.record_batch(out, names=[f"c{i}" for i in range(len(out))])


def mix_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                  length_col: str | None = "n_chars", **how) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row per document and pass that takes words of
    it, with the words of that pass as its text (the whole text unchanged if all are taken, else
    the taken runs, one a line). A document whose words aren't taken has no row; null, empty and blank
    texts have no words. Repeated rows, and ids that several rows share (ties), are documents of their
    own; long texts are cut by the blocks like any; columns of any name are kept; an empty table gives
    no rows."""
    prepare(docs.sparkSession)
    rows, uid = numbered(docs)
    _, pieces = lay_out(rows.select(F.col(uid).alias("uid"), F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(source_col)).alias("source"),
                                    F.col(quoted(text_col)).alias("text")), **how)
    runs = cut(pieces.groupBy("uid").agg(F.collect_list(F.struct("first", "words", "times")).alias("runs")), "runs")  # a document's own blocks
    names = docs.columns
    at = names.index(text_col)
    length = names.index(length_col) if length_col in names else None
    runs = runs.select(F.col("uid").alias("mix_uid"), F.col("runs").alias("mix_runs"))
    # positional names: a user's columns may be called anything
    taken = rows.select(*[c.alias(f"c{i}") for i, c in enumerate(columns_of(docs))], F.col(uid).alias("mix_uid")) \
        .withColumn(f"c{at}", F.col(f"c{at}").cast("string")).join(runs, "mix_uid") \
        .select(*[f"c{i}" for i in range(len(names))], "mix_runs")
    kind = ", ".join(f"c{i} {'string' if i == at else f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    mixed = taken.mapInArrow(partial(_mix_batches, at=at, length=length), kind)
    return mixed.select(*[F.col(f"c{i}").cast(f.dataType).alias(f.name) for i, f in enumerate(docs.schema)])
