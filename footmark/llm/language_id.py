"""Language identification by rank-order n-gram profiles.

A profile is the list of a language's most frequent n-grams (1 to 3 letters, a space before each
word), in order. A document's own list is compared with each profile by the out-of-place
distance: the sum of the differences in rank, with a fixed penalty for n-grams that the profile
lacks. Training counts all n-grams of all training texts: each task sends its own sums per
(language, n-gram), so the shuffle has distinct n-grams, not text. Profiles are the only data that
go to the driver and to the tasks: PROFILE rows a language.
"""

from __future__ import annotations

from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footmark.llm.common import chunks, codepoints, prepare, texts_of

#: N-grams of a profile, and of a document's list.
PROFILE = 400
#: Share of the labelled texts whose out-of-fold distance the bound of ``farthest`` starts from.
SURE = 0.999
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: itself in lower case if it is a letter, else 0."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000:
            continue
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def _letter_runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters in lower case with a single space before each word, all texts in a row, and the offsets."""
    _, cp, off = codepoints(texts)
    low = _letters()[cp]
    # a mark before each text keeps the texts apart; of non-letters, one before each word stays
    marked = np.insert(low, off[:-1], 0) if len(texts) else low
    owner = np.insert(np.repeat(np.arange(len(texts)), np.diff(off)), off[:-1], np.arange(len(texts)))
    keep = marked > 0
    keep[:-1] |= (marked[1:] > 0) & (owner[1:] == owner[:-1])
    out = np.where(marked > 0, marked, 32)[keep]
    return out, np.searchsorted(owner[keep], np.arange(len(texts) + 1))


def _grams(run: np.ndarray) -> np.ndarray:
    """Keys of all 1-, 2- and 3-grams of one text's letters (21 bits a letter); a lone space is none."""
    a = run.astype(np.int64)
    two = (a[:-1] << 21) | a[1:]
    three = (two[:-1] << 21) | a[2:]
    return np.concatenate([a[a != 32], two, three])


def _count_batches(batches):
    total: dict[str, list] = {}

    def merged(parts):
        keys, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return keys, np.bincount(inverse, np.concatenate([p[1] for p in parts])).astype(np.int64)

    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), texts_of(batch.column(1))
        for lo, hi in chunks(texts):
            runs, off = _letter_runs(texts[lo:hi])
            by: dict[str, list] = {}
            for i in range(hi - lo):
                if off[i + 1] > off[i]:
                    by.setdefault(langs[lo + i], []).append(_grams(runs[off[i]:off[i + 1]]))
            for lang, grams in by.items():
                total.setdefault(lang, []).append(np.unique(np.concatenate(grams), return_counts=True))
                if len(total[lang]) > 8:
                    total[lang] = [merged(total[lang])]
    for lang, parts in total.items():
        keys, counts = merged(parts)
        yield pa.record_batch([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)],
                              names=["lang", "gram", "n"])


def learn_profiles(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text",
                   size: int = PROFILE) -> dict[str, list[int]]:
    """language -> its n-grams, most frequent first (ties: smaller key). Rows with a null language
    or text teach nothing. The result has ``size`` numbers a language."""
    prepare(labelled.sparkSession)
    counts = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()) \
        .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(_count_batches, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    found = counts.select("lang", "gram", rank.alias("rank")).filter(F.col("rank") <= size).toArrow() \
        .sort_by([("lang", "ascending"), ("rank", "ascending")])
    lang, gram = found.column("lang").to_pylist(), found.column("gram").to_pylist()
    profiles: dict[str, list[int]] = {}
    for x, g in zip(lang, gram):
        profiles.setdefault(x, []).append(g)
    return profiles


class Ranks:
    """The profiles by n-gram: ``grams`` sorted, and for each the languages that have it and its rank
    there, one after the other (``size`` numbers a language, however many languages there are)."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE):
        self.langs, self.size = sorted(profiles), size
        gram = np.concatenate([np.array(profiles[x], dtype=np.int64) for x in self.langs] or [np.zeros(0, np.int64)])
        lang = np.repeat(np.arange(len(self.langs)), [len(profiles[x]) for x in self.langs])
        rank = np.concatenate([np.arange(len(profiles[x])) for x in self.langs] or [np.zeros(0, np.int64)])
        order = np.argsort(gram, kind="stable")
        self.grams, first = np.unique(gram[order], return_index=True)
        self.first = np.append(first, len(gram))
        self.lang, self.rank = lang[order].astype(np.int32), rank[order].astype(np.int32)

    def distances(self, run: np.ndarray) -> tuple[np.ndarray, int]:
        """(out-of-place distance to each language, n-grams compared) of one text's letters."""
        size, keys = self.size, np.sort(_grams(run))
        start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        n = np.diff(np.append(start, len(keys)))
        keys = keys[start]
        if len(n) > size:  # the most frequent; ties: smaller key
            kth = np.partition(n, len(n) - size)[len(n) - size]
            sure, tied = np.flatnonzero(n > kth), np.flatnonzero(n == kth)
            pick = np.sort(np.concatenate([sure, tied[:size - len(sure)]]))
            keys, n = keys[pick], n[pick]
        keys = keys[np.argsort(-n, kind="stable")]
        at = np.minimum(np.searchsorted(self.grams, keys), len(self.grams) - 1)
        place = np.flatnonzero(self.grams[at] == keys)
        lo, count = self.first[at[place]], np.diff(self.first)[at[place]]
        ends = np.cumsum(count)
        entry = np.repeat(lo - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)
        place = np.repeat(place, count)
        near = np.abs(self.rank[entry] - place) - size      # what a shared n-gram takes off the full penalty
        return size * len(keys) + np.bincount(self.lang[entry], near, len(self.langs)).astype(np.int64), len(keys)

    def predict(self, run: np.ndarray) -> tuple[str, float, float]:
        """(nearest language, score, distance to it from 0 to 1). The score compares the two nearest distances."""
        far, n = self.distances(run)
        best = int(np.argmin(far))
        part = float(far[best] / (self.size * n))
        if len(far) == 1:
            return self.langs[best], 1.0 - part, part
        second = np.partition(far, 1)[1]
        return self.langs[best], float(second / (far[best] + second)) if second else 0.5, part


def _predict_texts(texts: list[str], ranks: Ranks) -> tuple[list, list, list]:
    pred, score, part = [UNKNOWN] * len(texts), [0.0] * len(texts), [1.0] * len(texts)
    for lo, hi in chunks(texts) if ranks.langs else ():
        runs, off = _letter_runs(texts[lo:hi])
        for i in range(hi - lo):
            if off[i + 1] > off[i]:
                pred[lo + i], score[lo + i], part[lo + i] = ranks.predict(runs[off[i]:off[i + 1]])
    return pred, score, part


def _predict_batches(batches, ranks):
    for batch in batches:
        pred, score, _ = _predict_texts(texts_of(batch.column(1)), ranks)
        yield pa.record_batch([batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                              names=["key", "lang_pred", "score"])


def nearest(text: Column, profiles: dict[str, list[int]], size: int = PROFILE) -> Column:
    """struct(lang_pred, score, distance) of a text column, as ``predict`` has them; the distance is the
    share of the largest possible one, 1 where nothing was compared."""
    ranks = Ranks(profiles, size)

    def of(column: pa.Array) -> pa.Array:
        pred, score, part = _predict_texts(texts_of(column), ranks)
        return pa.StructArray.from_arrays([pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(part, pa.float64())],
                                          names=["lang_pred", "score", "distance"])
    of.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(of, "lang_pred string, score double, distance double").asNondeterministic()(text)


def farthest(labelled: DataFrame, key: str = "doc_id", lang_col: str = "lang", text_col: str = "text", size: int = PROFILE,
             sure: float = SURE) -> float:
    """The distance beyond which a text is in none of the learned languages.

    Both halves of the labelled texts (by a hash of the id) are measured with the profiles of the
    other half; the bound lies halfway between the distance that a share ``sure`` of them keeps below
    and the largest possible one, 1. Without labelled texts it is 1."""
    half = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(2))
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    parts = []
    for side in (0, 1):
        profiles = learn_profiles(rows.filter(half != side), lang_col, text_col, size)
        parts.append(rows.filter(half == side).select(nearest(F.col(text_col).cast("string"), profiles, size).alias("seen"))
                     .filter(F.col("seen.lang_pred") != UNKNOWN).select("seen.distance"))
    most = parts[0].union(parts[1]).agg(F.percentile_approx("distance", sure, 100_000)).first()[0]
    return 1.0 if most is None else (1.0 + most) / 2


def predict(docs: DataFrame, profiles: dict[str, list[int]], key: str = "doc_id", text_col: str = "text",
            size: int = PROFILE) -> DataFrame:
    """One row per input row: key, lang_pred, score (0 to 1; 0.5: two languages equally near).

    Null texts, texts without a letter, and any text while no language was learned give ``und`` and
    0. Ties in distance take the first language by code point. Whole texts of any length are read;
    repeated rows and null keys keep their rows; only the two columns are read."""
    prepare(docs.sparkSession)
    src = docs.select(F.col(key), F.col(text_col).cast("string"))
    kind = src.schema[0].dataType.simpleString()
    return src.mapInArrow(partial(_predict_batches, ranks=Ranks(profiles, size)),
                          f"key {kind}, lang_pred string, score double")
