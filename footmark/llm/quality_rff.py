"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Statistics of the whole text (lengths, shares of character kinds, repetition) are standardised by
their mean and deviation over all documents, and mapped to random Fourier features, whose inner
products approximate a Gaussian kernel. Tasks sum Z'Z and Z'y of their labelled rows by fold; the
summed normal equations give the ridge weights of all rows and, by leaving a fold's sums out, of
each fold. The out-of-fold scores, as a histogram, calibrate the score by isotonic regression.

The driver sees only sums whose size depends on the number of features and bins.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footmark.llm.common import chunks, codepoints, cut, hash_runs, prepare, texts_of, word_starts

FEATURES = 192
GAMMA = 0.02
RIDGE = 1e-3
FOLDS = 3
BINS = 1024
SEED = 20240617

STATS = ("log_chars", "log_words", "log_lines", "word_len", "word_len_dev", "long_words", "letters", "upper", "digits", "spaces",
         "marks", "symbols", "bars", "exclaims", "ends", "short_words", "upper_words", "symbol_words", "distinct_words",
         "distinct_lines", "line_len", "entropy", "brackets", "adjacent")


def _tables() -> np.ndarray:
    """A row of flags for each code point below 256 (others: letter or not by a separate rule)."""
    kinds = np.zeros((256, 8), dtype=bool)
    for c in range(256):
        ch = chr(c)
        kinds[c] = (ch.isalpha(), ch.isupper(), ch.isdigit(), ch.isspace(), ch in ".,;:?'\"-()", ch in "#$%&*@^~=+_\\/<>{}[]`",
                    ch == "|", ch == "!")
    return kinds


def statistics(texts: list[str]) -> np.ndarray:
    """Statistics of each text; of one without words, zeros."""
    _, cp, off = codepoints(texts)
    out = np.zeros((len(texts), len(STATS)))
    mask, pos, woff = word_starts(cp, off)
    if not len(pos):
        return out
    kinds = _tables()
    small = np.minimum(cp, 255)  # (the table's last row is a plain letter, as all code points beyond it count)
    chars, words = np.diff(off), np.diff(woff)
    freq = np.bincount(np.repeat(np.arange(len(texts)), chars) * 256 + small, minlength=256 * len(texts)).reshape(-1, 256)

    def per_word(flag):
        total = np.zeros(len(cp) + 1, dtype=np.int64)
        np.cumsum(flag[small], out=total[1:])
        return total[ends] - total[pos]

    widx = np.cumsum(mask)[pos] - 1
    wlen = np.diff(np.append(widx, int(mask.sum())))
    ends = pos + wlen
    hashes = hash_runs(cp[mask], widx)
    upper, last = per_word(kinds[:, 1]), cp[ends - 1]
    same = np.zeros(len(pos), dtype=bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[woff[:-1][words > 0]] = False
    owner = np.repeat(np.arange(len(texts)), words)
    order = np.lexsort((hashes, owner))
    fresh = np.ones(len(pos), dtype=bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[1:] != owner[:-1])
    of_word = np.stack([wlen, wlen ** 2, wlen > 20, (last == 46) | (last == 63), wlen <= 3, (upper >= 2) & (upper >= per_word(kinds[:, 0])),
                        per_word(kinds[:, 5:].any(axis=1)) > 0, same, fresh], axis=1).astype(float)

    have = np.flatnonzero(words)
    n, c, freq = words[have], chars[have], freq[have]
    sums = np.add.reduceat(of_word, woff[:-1][have], axis=0)
    w = sums / n[:, None]
    share = freq @ kinds.astype(np.int64) / c[:, None]
    lines = freq[:, 10] + 1
    unlike = np.array([len(set(texts[i].split("\n"))) for i in have])
    p = freq / c[:, None]
    entropy = -(p * np.log(np.where(p > 0, p, 1.0))).sum(axis=1)
    distinct = np.where(n > 1, np.log(sums[:, 8]) / np.log(n + 1), 1.0)
    columns = {"log_chars": np.log1p(c), "log_words": np.log1p(n), "log_lines": np.log1p(lines - 1), "word_len": w[:, 0],
               "word_len_dev": np.sqrt(np.maximum(w[:, 1] - w[:, 0] ** 2, 0)), "long_words": w[:, 2],
               "letters": share[:, 0], "upper": share[:, 1], "digits": share[:, 2], "spaces": share[:, 3], "marks": share[:, 4],
               "symbols": share[:, 5], "bars": share[:, 6], "exclaims": share[:, 7], "ends": w[:, 3], "short_words": w[:, 4],
               "upper_words": w[:, 5], "symbol_words": w[:, 6], "distinct_words": distinct, "distinct_lines": unlike / lines,
               "line_len": np.log1p(c / lines), "entropy": entropy,
               "brackets": freq[:, [ord(b) for b in "()<>[]{}"]].sum(axis=1) / c, "adjacent": w[:, 7]}
    out[have] = np.stack([columns[name] for name in STATS], axis=1)
    return out


def _stat_batches(batches):
    for batch in batches:
        texts = texts_of(batch.column(2))
        for lo, hi in chunks(texts):
            s = statistics(texts[lo:hi])
            yield pa.record_batch([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                                   pa.array(list(s), pa.list_(pa.float64()))], names=["doc_id", "held_out", "stats"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _moment_batches(batches):
    d = len(STATS)
    total = np.zeros((3, d))
    for batch in batches:
        s = _matrix(batch.column(0))
        total += [np.full(d, len(s)), s.sum(axis=0), (s ** 2).sum(axis=0)]
    yield pa.record_batch([pa.array(np.arange(d))] + [pa.array(t) for t in total], names=["j", "n", "s", "ss"])


class Features:
    """Standardisation and random Fourier features (with the standardised statistics and a constant)."""

    def __init__(self, mean: np.ndarray, dev: np.ndarray, features: int = FEATURES, gamma: float = GAMMA):
        g = np.random.default_rng(SEED)
        self.mean, self.dev = mean, np.where(dev > 1e-9, dev, 1.0)
        self.w = g.standard_normal((len(mean), features)) * math.sqrt(2 * gamma)
        self.b = g.uniform(0, 2 * math.pi, features)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.dev, -6, 6)
        z = np.cos(x @ self.w + self.b) * math.sqrt(2 / len(self.b))
        return np.concatenate([z, x / len(self.mean), np.ones((len(x), 1))], axis=1)


def _equation_batches(batches, features, slots):
    size = features.w.shape[1] + features.w.shape[0] + 1
    total = np.zeros((FOLDS, size, size + 1))
    seen, slot = False, 0
    for batch in batches:
        z, y, fold = features(_matrix(batch.column(0))), batch.column(1).to_numpy(), batch.column(2).to_numpy()
        if len(z):
            seen, slot = True, batch.column(3)[0].as_py() % slots
        for f in range(FOLDS):
            zf = z[fold == f]
            total[f] += zf.T @ np.concatenate([zf, y[fold == f][:, None]], axis=1)
    if seen:
        for f in range(FOLDS):
            yield pa.record_batch([pa.array([f], pa.int32()), pa.array([slot], pa.int32()), pa.array([total[f].tobytes()], pa.binary())],
                                  names=["fold", "slot", "m"])


def _sum_matrices(batches):
    """Sums by (fold, slot) of a partition; one matrix a key in memory."""
    held: dict = {}
    for batch in batches:
        for fold, slot, m in zip(*(c.to_pylist() for c in batch.columns)):
            m = np.frombuffer(m, dtype=np.float64)
            held[fold, slot] = held[fold, slot] + m if (fold, slot) in held else m
    for (fold, slot), m in held.items():
        yield pa.record_batch([pa.array([fold], pa.int32()), pa.array([slot], pa.int32()), pa.array([m.tobytes()], pa.binary())],
                              names=["fold", "slot", "m"])


def _bin_batches(batches, features, weights):
    count = np.zeros((2, BINS), dtype=np.int64)
    for batch in batches:
        z, y, fold = features(_matrix(batch.column(0))), batch.column(1).to_numpy(), batch.column(2).to_numpy()
        at = _bins((z * weights[fold]).sum(axis=1))
        for c in (0, 1):
            count[c] += np.bincount(at[y == c], minlength=BINS)
    yield pa.record_batch([pa.array(np.arange(BINS)), pa.array(count[0]), pa.array(count[1])], names=["bin", "n0", "n1"])


def _bins(score: np.ndarray) -> np.ndarray:
    """Raw scores from -0.5 to 1.5 in equal bins; beyond them the outer bins."""
    return np.clip((score + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int64)


def isotonic(n: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Non-decreasing rates of consecutive bins (pool adjacent violators); empty bins take the
    nearest lower rate, at the start the first one; a pool's rate is smoothed by half a count."""
    blocks: list[list[float]] = []
    for at in np.flatnonzero(n):
        blocks.append([float(positive[at]), float(n[at]), 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            p, m, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + p, blocks[-1][1] + m, blocks[-1][2] + k]
    if not blocks:
        return np.full(len(n), 0.5)
    fit = np.concatenate([np.full(int(k), (p + 0.5) / (m + 1)) for p, m, k in blocks])
    fit = np.maximum.accumulate(fit)
    return fit[np.maximum(np.searchsorted(np.flatnonzero(n), np.arange(len(n)), side="right") - 1, 0)]


def _score_batches(batches, features, weights, rates):
    for batch in batches:
        z = features(_matrix(batch.column(2)))
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(rates[_bins(z @ weights)])], names=["doc_id", "held_out", "score"])


def score_quality(docs: DataFrame, labels: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", threshold: float = 0.7) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1), predicted.

    ``held_out``: a boolean column of ``docs``; such rows teach nothing. All other rows with a label
    0 or 1 teach, once for each row of that id in either table. Null and empty texts have statistics
    of zero and are scored as any other; with no teaching rows every score is 0.5; null ids teach
    nothing and keep their rows; an empty table gives no rows; other columns aren't read."""
    spark = docs.sparkSession
    prepare(spark)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text_col).cast("string").alias("text"))
    stats = cut(src.mapInArrow(_stat_batches, "doc_id long, held_out boolean, stats array<double>"), "stats")
    moments = stats.select("stats").mapInArrow(_moment_batches, "j long, n double, s double, ss double") \
        .groupBy("j").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss")).orderBy("j").collect()
    n, s, ss = (np.array([m[c] for m in moments] or [0.0] * len(STATS)) for c in ("n", "s", "ss"))
    mean = s / np.maximum(n, 1)
    features = Features(mean, np.sqrt(np.maximum(ss / np.maximum(n, 1) - mean ** 2, 0)))
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).filter("y in (0, 1)")
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int")
    teach = cut(stats.filter(~F.col("held_out")).join(known, "doc_id").select("stats", "y", fold.alias("fold")), "teach")
    size = FEATURES + len(STATS) + 1
    slots = max(1, math.isqrt(teach.rdd.getNumPartitions()))
    kind = "fold int, slot int, m binary"
    parts = teach.withColumn("pid", F.spark_partition_id()).mapInArrow(partial(_equation_batches, features=features, slots=slots), kind)
    sums = parts.repartition(slots, "slot").mapInArrow(_sum_matrices, kind).withColumn("slot", F.lit(0))
    sums = sums.repartition(FOLDS, "fold").mapInArrow(_sum_matrices, kind).collect()  # one matrix a fold
    by_fold = np.zeros((FOLDS, size, size + 1))
    for r in sums:
        by_fold[r["fold"]] += np.frombuffer(r["m"], dtype=np.float64).reshape(size, size + 1)

    def solve(m):
        return np.linalg.solve(m[:, :size] + np.eye(size) * (RIDGE * max(m[-1, size - 1], 1.0)), m[:, size])

    whole = by_fold.sum(axis=0)
    weights = solve(whole)
    left_out = np.array([solve(whole - by_fold[f]) for f in range(FOLDS)])
    bins = teach.select("stats", "y", "fold").mapInArrow(partial(_bin_batches, features=features, weights=left_out), "bin long, n0 long, n1 long") \
        .groupBy("bin").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).orderBy("bin").collect()
    n0, n1 = (np.array([b[c] for b in bins] or [0] * BINS) for c in ("n0", "n1"))
    rates = isotonic(n0 + n1, n1)
    return stats.mapInArrow(partial(_score_batches, features=features, weights=weights, rates=rates),
                            "doc_id long, held_out boolean, score double") \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
