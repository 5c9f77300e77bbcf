"""Toxicity by a classifier chain.

The categories are predicted in a fixed order. Each link is a logistic model on the presence of
words, and the probabilities of the earlier links are further inputs of the later ones. In training
these inputs are out-of-fold predictions, so that a later link learns to trust an earlier one as far
as it deserves on unseen texts: the rows of a fold take no part in the choice of its words either,
and copies of a text share a fold.

The models are fitted on a bounded sample of the labelled rows (SAMPLE, the smallest hashes of their
ids). The words are counted and ranked by Spark; of the sample's texts only the presence of chosen
words reaches the driver (at most WORDS a link and fold). Scoring is one map over all texts with at
most WORDS weights a link.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footmark.llm.common import chunks, codepoints, cut, hash_runs, mix, prepare, texts_of
from footmark.llm.language_id import _letters

#: Labelled rows to fit on, at most; words that a link may use; folds; ridge penalty.
SAMPLE = 12000
WORDS = 300
FOLDS = 3
RIDGE = 0.05
#: A word must occur in so many texts of the sample.
LEAST = 5


def word_sets(texts: list[str]) -> list[np.ndarray]:
    """Hashes of the distinct words (runs of letters in lower case) and symbols of each text."""
    _, cp, off = codepoints(texts)
    out = [np.zeros(0, dtype=np.int64)] * len(texts)
    if not len(cp):
        return out
    low = _letters()[cp]
    letter = low > 0
    start = letter.copy()
    start[1:] &= ~letter[:-1]
    heads = off[:-1][off[:-1] < off[1:]]
    start[heads] = letter[heads]
    pos = np.flatnonzero(start)
    words = hash_runs(low[letter], np.cumsum(letter)[pos] - 1) if len(pos) else np.zeros(0, dtype=np.uint64)
    symbol = np.flatnonzero(~letter & (cp > 32) & ~((cp >= 48) & (cp <= 57)))
    marks = mix(cp[symbol].astype(np.uint64), 31)
    w, m = np.searchsorted(pos, off), np.searchsorted(symbol, off)
    return [np.unique(np.concatenate([words[w[i]:w[i + 1]], marks[m[i]:m[i + 1]]])).view(np.int64) for i in range(len(texts))]


def _word_batches(batches):
    for batch in batches:
        texts = texts_of(batch.column(0))
        for lo, hi in chunks(texts):
            yield pa.record_batch([pa.array(word_sets(texts[lo:hi]), pa.list_(pa.int64())), batch.column(1).slice(lo, hi - lo),
                                   batch.column(2).slice(lo, hi - lo)], names=["words", "y", "fold"])


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 12) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last column of ``x`` is the constant."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _design(sets: list[np.ndarray], words: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    """Presence of the chosen words, earlier probabilities (as odds), and a constant."""
    x = np.zeros((len(sets), len(words) + earlier.shape[1] + 1))
    for i, s in enumerate(sets):
        if len(words) and len(s):
            at = np.minimum(np.searchsorted(s.view(np.uint64), words.view(np.uint64)), len(s) - 1)
            x[i, :len(words)] = s[at] == words
    x[:, len(words):-1] = np.log((earlier + 1e-3) / (1 - earlier + 1e-3))
    x[:, -1] = 1
    return x


def choose_words(sets: list[np.ndarray], y: np.ndarray, size: int = WORDS) -> np.ndarray:
    """The words with the largest chi-square against the category (ties: smaller hash), sorted."""
    all_words = np.concatenate(sets) if sets else np.zeros(0, np.int64)
    keys, inverse, n = np.unique(all_words.view(np.uint64), return_inverse=True, return_counts=True)
    if not len(keys):
        return np.zeros(0, dtype=np.int64)
    hit = np.bincount(inverse, np.repeat(y, [len(s) for s in sets]), minlength=len(keys))
    total, rate = len(sets), y.mean()
    spread = n * rate * (1 - rate) * np.maximum(1 - n / total, 1e-9)
    chi = np.where(n >= LEAST, (hit - n * rate) ** 2 / np.maximum(spread, 1e-12), 0)
    best = np.lexsort((keys, -chi))[:size]
    return np.sort(keys[best[chi[best] > 10]]).view(np.int64)


def candidate_words(rows: DataFrame, categories: int, size: int = WORDS) -> list[int]:
    """All words that :func:`choose_words` takes for some category from the rows outside some fold,
    or from all rows; counted and ranked by Spark. ``rows``: words, y (0 or 1 a category), fold."""
    def counted(n):
        """``n`` summed over the rows outside each fold, then over all."""
        return [F.sum(F.when(F.col("fold") != f, n).otherwise(0)) for f in range(FOLDS)] + [F.sum(n)]

    counts = [F.lit(1), *[F.col("y")[c] for c in range(categories)]]
    whole = [v or 0 for v in rows.agg(*[v for n in counts for v in counted(n)]).first()]
    found = rows.select(F.explode("words").alias("word"), "y", "fold").groupBy("word") \
        .agg(*[F.array(*counted(n)).cast("array<double>").alias(f"n{i}") for i, n in enumerate(counts)])
    ranked = []
    for f in range(FOLDS + 1):
        total = max(whole[f], 1)
        for c in range(categories):
            rate = whole[(c + 1) * (FOLDS + 1) + f] / total
            n, off = F.col("n0")[f], F.col(f"n{c + 1}")[f] - F.col("n0")[f] * F.lit(rate)
            spread = n * F.lit(rate) * F.lit(1 - rate) * F.greatest(1 - n / F.lit(float(total)), F.lit(1e-9))
            chi = F.when(n >= LEAST, off * off / F.greatest(spread, F.lit(1e-12)))
            ranked.append(F.struct(F.lit(f * categories + c).alias("group"), chi.alias("chi")))
    order = Window.partitionBy("group").orderBy(F.desc("chi"), F.col("word").bitwiseXOR(F.lit(-1 << 63)))  # unsigned
    best = found.select("word", F.inline(F.array(*ranked))).filter("chi > 10") \
        .withColumn("at", F.row_number().over(order)).filter(F.col("at") <= size)
    return sorted(r[0] for r in best.select("word").distinct().collect())  # at most ``size`` a fold and category


def fit_chain(sets: list[np.ndarray], y: np.ndarray, fold: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(words, weights) of each link; ``y`` has a column a category."""
    links, earlier = [], np.zeros((len(sets), 0))
    for c in range(y.shape[1]):
        target = y[:, c].astype(float)
        words = choose_words(sets, target)
        links.append((words, fit_logistic(_design(sets, words, earlier), target)))
        unseen = np.zeros(len(sets))
        for f in range(FOLDS):
            out = fold == f
            x = _design(sets, choose_words([s for s, o in zip(sets, out) if not o], target[~out]), earlier)
            unseen[out] = _sigmoid(x[out] @ fit_logistic(x[~out], target[~out]))
        earlier = np.concatenate([earlier, unseen[:, None]], axis=1)
    return links


def _score_batches(batches, links):
    for batch in batches:
        texts = texts_of(batch.column(2))
        for lo, hi in chunks(texts):
            sets = word_sets(texts[lo:hi])
            p = np.zeros((hi - lo, 0))
            for words, w in links:
                p = np.concatenate([p, _sigmoid(_design(sets, words, p) @ w)[:, None]], axis=1)
            yield pa.record_batch([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                                   pa.array(list(p), pa.list_(pa.float64()))], names=["doc_id", "held_out", "p"])


def score_toxicity(docs: DataFrame, labels: DataFrame, held_out, categories: dict[str, object], id_col: str = "doc_id",
                   text_col: str = "text", threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """One row per input row: doc_id, held_out, a probability p_<category> for each, score (that of
    the last category, 0 to 1) and predicted (1 if score >= threshold).

    ``categories``: name -> boolean column over ``labels``, in the order of the chain; rows of which
    a category is null teach nothing, and so do ``held_out`` rows and null ids; a label that repeats
    teaches once for each of its rows, a text that repeats under one id once for all. Null and empty texts have no words and get the base rates;
    with nothing to learn from all probabilities are 0.5. Repeated rows and null ids keep their
    rows; whole texts of any length are read; an empty table gives no rows; other columns aren't read."""
    spark = docs.sparkSession
    prepare(spark)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text_col).cast("string").alias("text"))
    y = F.array(*[c.cast("int") for c in categories.values()])
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), y.alias("y")).filter(~F.exists("y", lambda v: v.isNull()))
    text_hash = F.xxhash64("text").alias("h")
    learnt = src.filter(F.expr("not held_out and doc_id is not null")).select("doc_id", text_hash, "text")
    ids = learnt.select("doc_id", "h").distinct().join(known, "doc_id")
    # bounded: ``sample`` rows, however often an id or a text repeats
    ids = cut(ids.orderBy(F.xxhash64("doc_id", "h"), "doc_id", "h").limit(sample), "sample")
    texts = learnt.join(F.broadcast(ids.select("doc_id", "h").distinct()), ["doc_id", "h"], "left_semi") \
        .groupBy("doc_id", "h").agg(F.first("text").alias("text"))
    fold = F.pmod(F.xxhash64("h", F.lit(7)), F.lit(FOLDS)).cast("int")
    rows = cut(texts.join(F.broadcast(ids), ["doc_id", "h"]).select("text", "y", fold.alias("fold"))
               .mapInArrow(_word_batches, "words array<long>, y array<int>, fold int"), "words")
    listed = ", ".join(f"bigint('{w}')" for w in candidate_words(rows, len(categories)))
    held = F.array_intersect("words", F.expr(f"cast(array({listed}) as array<bigint>)"))
    rows = rows.select(held.alias("words"), "y", "fold").toArrow()
    if rows.num_rows:
        words = rows.column("words").combine_chunks()
        ends = np.cumsum(words.value_lengths().to_numpy())
        sets = np.split(words.flatten().to_numpy(), ends[:-1])
        links = fit_chain(sets, np.array(rows.column("y").to_pylist()), rows.column("fold").to_numpy())
    else:
        links = [(np.zeros(0, np.int64), np.zeros(c + 1)) for c in range(len(categories))]
    out = src.mapInArrow(partial(_score_batches, links=links), "doc_id long, held_out boolean, p array<double>")
    out = out.select("doc_id", "held_out", *[F.col("p")[i].alias(f"p_{c}") for i, c in enumerate(categories)],
                     F.col("p")[len(categories) - 1].alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
