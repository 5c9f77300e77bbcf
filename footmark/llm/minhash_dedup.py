"""Near-duplicate documents by min-max hashing.

Each permutation of the shingle hashes is evaluated once and gives two signature values, its
minimum and its maximum, so a signature of 2K values costs K evaluations. The values are banded
(bands of minima, bands of maxima); documents that share a band are candidates, and every link is
confirmed on the full shingle sets.

Plan:
  1. one pass over the texts: set size, a 128-bit hash of the set and the band keys;
  2. equal sets collapse to one representative row, the node of the links (partial aggregation
     absorbs hot copy groups; ids play no part, so an id may have several texts);
  3. in each bucket the member whose buckets are the largest in sum is the leader (of a group of
     near copies the one most like the others); every member is checked against the leader (linear
     in the bucket, never all pairs), and the links give components;
  4. buckets that still hold several components give further pairs of members of different
     components that were not checked yet. A shingle is rare if at most RARE of these members have
     it. A pair either shares a rare shingle (at most RARE members each, so few such pairs), or its
     intersection has at most the smaller number of common shingles, which leaves few pairs. Both
     kinds are checked; the rest is proven not to link, and there is no cap;
  5. components go back to all documents by the set hash, with their smallest id.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footmark.llm.common import chunks, codepoints, cut, lower_ascii, mix, prepare, texts_of, words_hash
from footmark.llm.components import components

#: Permutations; each gives a minimum and a maximum.
PERMUTATIONS = 50
#: A pair exactly at the threshold may be missed by all bands with at most this probability.
MISS = 1e-5
#: A shingle is rare if at most so many of the members in question have it (any value gives the same links).
RARE = 32


def band_rows(similarity: float, permutations: int = PERMUTATIONS, miss: float = MISS) -> int:
    """Rows per band: the most (so the fewest false candidates) that keep the miss bound."""
    best = 1
    for r in range(1, permutations + 1):
        bands = 2 * (permutations // r)
        if bands and bands * math.log1p(-similarity ** r) <= math.log(miss):
            best = r
    return best


def shingle_sets(texts: list[str], k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of each text (A-Z in lower case); a text of
    fewer words has its whole sequence as one shingle, one without words none."""
    _, cp, off = codepoints(texts)
    h, woff = words_hash(lower_ascii(cp), off)
    n = np.diff(woff)
    m = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    ends = np.cumsum(m)
    i = np.repeat(woff[:-1], m) + np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - m, m)
    last = np.repeat(woff[1:], m)
    s = np.zeros(len(i), dtype=np.uint64)
    for j in range(k):
        at = np.minimum(i + j, max(len(h) - 1, 0))
        s += np.where(i + j < last, mix(h[at], j + 1) if len(h) else 0, np.uint64(0))
    s = mix(s, k)
    return [np.unique(s[e - c:e]) for e, c in zip(ends, m)]


def _signatures(sets: list[np.ndarray], rows: int, permutations: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Band keys (one row a set) and two 64-bit hashes of each set; no set may be empty."""
    u = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    lo, hi = u.astype(np.uint32), (u >> np.uint64(32)).astype(np.uint32)
    rng = np.random.default_rng(20240607)
    a, c = (rng.integers(0, 2 ** 31, permutations, dtype=np.uint32) * np.uint32(2) + np.uint32(1) for _ in range(2))
    sig = np.empty((2, permutations, len(sets)), dtype=np.uint32)
    for p in range(permutations):
        y = lo * a[p] + hi * c[p]
        sig[0, p] = np.minimum.reduceat(y, starts)
        sig[1, p] = np.maximum.reduceat(y, starts)
    per = permutations // rows
    keys = np.empty((len(sets), 2 * per), dtype=np.uint64)
    for side in range(2):
        for b in range(per):
            k = np.full(len(sets), side * per + b, dtype=np.uint64)
            for r in range(rows):
                k = mix(k * np.uint64(0x9E3779B97F4A7C15) + sig[side, b * rows + r].astype(np.uint64))
            keys[:, side * per + b] = k
    return keys, np.add.reduceat(mix(u, 11), starts), np.add.reduceat(mix(u, 12), starts)


def _sign_batches(batches, k: int, rows: int, permutations: int):
    for batch in batches:
        numbers, ids, texts = batch.column(0), batch.column(1), texts_of(batch.column(2))
        for lo, hi in chunks(texts):
            sets = shingle_sets(texts[lo:hi], k)
            n = np.array([len(s) for s in sets], dtype=np.int64)
            h1, h2 = np.zeros(len(n), dtype=np.uint64), np.zeros(len(n), dtype=np.uint64)
            keys: list = [None] * len(n)
            full = np.flatnonzero(n)
            if len(full):
                key, h1[full], h2[full] = _signatures([sets[i] for i in full], rows, permutations)
                for i, row in zip(full, key.view(np.int64)):
                    keys[i] = row
            yield pa.record_batch([numbers.slice(lo, hi - lo), ids.slice(lo, hi - lo), pa.array(n), pa.array(h1.view(np.int64)),
                                   pa.array(h2.view(np.int64)), pa.array(keys, pa.list_(pa.int64()))],
                                  names=["row", "doc_id", "n", "h1", "h2", "bands"])


def _set_batches(batches, k: int):
    for batch in batches:
        texts, ids = texts_of(batch.column(1)), batch.column(0)
        for lo, hi in chunks(texts):
            sets = [s.view(np.int64) for s in shingle_sets(texts[lo:hi], k)]
            yield pa.record_batch([ids.slice(lo, hi - lo), pa.array(sets, pa.list_(pa.int64()))], names=["id", "shingles"])


def _verify_batches(batches, percent: int):
    for batch in batches:
        a, b, x, y = batch.columns
        keep = []
        xs, ys = (c.flatten().to_numpy().view(np.uint64) for c in (x, y))
        xo, yo = (np.concatenate([[0], np.cumsum(c.value_lengths().to_numpy())]) for c in (x, y))
        for i in range(batch.num_rows):
            s, t = xs[xo[i]:xo[i + 1]], ys[yo[i]:yo[i + 1]]
            if len(s) > len(t):
                s, t = t, s
            if 100 * len(s) < percent * len(t) or not len(s):
                keep.append(False)
                continue
            both = int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())
            keep.append(100 * both >= percent * (len(s) + len(t) - both))
        yield pa.record_batch([a, b], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough. The member's set is attached first, the
    leader's last: a hot leader then is a skewed stream side, which adaptive execution splits."""
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y")
    return both.mapInArrow(partial(_verify_batches, percent=percent), "a long, b long")


def _sign(src: DataFrame, shingle: int, percent: int, permutations: int) -> DataFrame:
    """src(row, doc_id, text): row, doc_id, n, h1, h2, bands of each row."""
    rows = band_rows(percent / 100, permutations)
    return cut(src.mapInArrow(partial(_sign_batches, k=shingle, rows=rows, permutations=permutations),
                              "row long, doc_id long, n long, h1 long, h2 long, bands array<long>"), "signatures")


def _groups(src: DataFrame, sig: DataFrame, shingle: int, percent: int) -> DataFrame:
    """For each set of ``sig`` (rows with a set): h1, h2, and of its component the smallest id
    (null if no row has one) and a row with this id. Row numbers of ``src`` must be written: the
    texts are read again by them."""
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    reps = cut(sig.groupBy("h1", "h2").agg(best.alias("best"), F.max("n").alias("n"), F.first("bands").alias("bands"))
               .select("h1", "h2", F.col("best.row").alias("rep"), F.col("best.doc_id").alias("rep_id"), "n", "bands"), "sets")
    keyed = reps.select("rep", "n", F.explode("bands").alias("key"))
    shared = cut(keyed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "shared")
    members = cut(keyed.join(shared, "key").select("key", "rep", "n", "size"), "members")
    weight = cut(members.groupBy("rep").agg(F.sum("size").alias("weight")), "weights")
    # the hint: which plan moves the texts shall not depend on the size of the input
    needed = weight.select(F.col("rep").alias("row")).hint("shuffle_hash")
    sets = cut(src.select("row", "text").join(needed, "row", "left_semi")
               .mapInArrow(partial(_set_batches, k=shingle), "id long, shingles array<long>"), "shingles")
    members = cut(members.join(weight, "rep"), "members")
    leaders = cut(members.groupBy("key").agg(F.min(F.struct(-F.col("weight"), "rep"))["rep"].alias("leader")), "leaders")
    members = cut(members.join(leaders, "key"), "members")
    first = members.filter("rep <> leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    links = cut(_verify(first, sets, percent), "links")
    comp = cut(components(links), "components")

    # Buckets that still hold several components: pairs of members of different components.
    labelled = cut(members.filter("size > 2").join(comp, F.col("rep") == F.col("node"), "left")
                   .select("key", "rep", "n", "leader", F.coalesce("component", "rep").alias("component")), "labelled")
    mixed = cut(labelled.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1"))
                .filter("c0 < c1").select("key"), "mixed")
    rest = cut(labelled.join(mixed, "key").filter("rep <> leader").select("key", "rep", "n", "component"), "rest")
    nodes = cut(rest.select(F.col("rep").alias("id"), "n", "component").distinct(), "nodes")
    held = cut(sets.join(nodes, "id").select("id", "n", "component", F.explode("shingles").alias("s")), "held")
    few = held.groupBy("s").agg(F.count("*").alias("c")).filter(F.col("c") <= RARE)
    rare = cut(held.join(cut(few, "few"), "s").select("s", "c", "id", "n", "component"), "rare")
    common = nodes.join(rare.groupBy("id").agg(F.count("*").alias("rare")), "id", "left") \
        .select("id", (F.col("n") - F.coalesce("rare", F.lit(0))).alias("common"))
    # what a member shares with no more than RARE others can't suffice: it needs percent % of its own size
    common = cut(common.join(nodes, "id").filter(100 * F.col("common") >= percent * F.col("n")).select("id", "common"), "common")
    rest = rest.join(common, F.col("rep") == F.col("id")) \
        .join(reps.select(F.col("rep").alias("id2"), "bands"), F.col("rep") == F.col("id2")) \
        .select("key", "rep", "n", "component", "common", F.slice("bands", 1, F.array_position("bands", F.col("key")) - 1).alias("before"))
    x = rest.select("key", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"), F.col("common").alias("sa"),
                    F.col("before").alias("ba"))
    y = rest.select("key", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"), F.col("common").alias("sb"),
                    F.col("before").alias("bb"))
    alike = (F.col("ca") < F.col("cb")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    by_common = x.join(y, (x["key"] == y["key"]) & alike
                       & ((100 + percent) * F.least("sa", "sb") >= percent * (F.col("na") + F.col("nb")))
                       & ~F.arrays_overlap("ba", "bb"))  # a pair counts in the first band that it shares
    rare = rare.filter("c > 1")
    x = rare.select("s", F.col("id").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"))
    y = rare.select("s", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"))
    by_rare = x.join(y, (x["s"] == y["s"]) & alike)
    second = by_common.select("a", "b").union(by_rare.select("a", "b")) \
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    more = cut(_verify(second, sets, percent), "links")
    if not more.isEmpty():
        comp = cut(components(comp.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)),
                   "components")
    first = F.min(F.struct(F.col("rep_id").isNull().alias("none"), "rep_id", "rep"))
    labels = cut(comp.join(reps.select("rep", "rep_id"), F.col("rep") == F.col("node")).groupBy("component").agg(first.alias("first"))
                 .select("component", F.col("first.rep_id").alias("first_id"), F.col("first.rep").alias("first_row")), "labels")
    named = comp.join(labels, "component").select("node", "first_id", "first_row")
    return cut(reps.select("h1", "h2", "rep", "rep_id").join(named, F.col("rep") == F.col("node"), "left")
               .select("h1", "h2", F.when(F.col("node").isNull(), F.col("rep_id")).otherwise(F.col("first_id")).alias("first_id"),
                       F.coalesce("first_row", "rep").alias("first_row")), "by_set")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 5,
                    percent: int = 80, permutations: int = PERMUTATIONS) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Two documents link when 100 * |intersection| >= percent * |union| of their sets of
    ``shingle``-word shingles; component_id is the smallest id reachable by links.

    Defined results: null and empty texts have no shingles and link with nothing; texts with fewer
    words than a shingle have their whole sequence as one; a row with a null id links with nothing
    and has a null component_id and kept = true; repeated rows are equal sets under one id; rows
    that share an id but not a text count each with the links of their own set, and don't join
    these; an empty table gives no rows; only the two named columns are read."""
    prepare(docs.sparkSession)
    src = cut(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                          F.col(text_col).cast("string").alias("text")), "rows")
    sig = _sign(src, shingle, percent, permutations)
    by_set = _groups(src, sig.filter("n > 0 and doc_id is not null"), shingle, percent)
    out = sig.select("doc_id", "n", F.when(F.expr("n > 0 and doc_id is not null"), F.col("h1")).alias("h1"), "h2") \
        .join(by_set, ["h1", "h2"], "left")
    comp_id = F.coalesce("first_id", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), comp_id.alias("component_id"),
                      F.coalesce(F.col("doc_id") == comp_id, F.lit(True)).alias("kept"))


def repeated_rows(docs: DataFrame, row_col: str, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 5,
                  percent: int = 80, permutations: int = PERMUTATIONS) -> DataFrame:
    """The ``row_col`` of all rows but one of each component: the row with the smallest id stays
    (a null id counts as larger than any; of several, the smallest row number). Links are those of
    ``near_duplicates``, but between rows: neither a shared id nor a null one plays a part, and rows
    without a shingle all stay. ``row_col`` must be unique and written, not computed."""
    prepare(docs.sparkSession)
    src = docs.select(F.col(row_col).cast("long").alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                      F.col(text_col).cast("string").alias("text"))
    sig = _sign(src, shingle, percent, permutations).filter("n > 0")
    by_set = _groups(src, sig, shingle, percent)
    return sig.select("row", "h1", "h2").join(by_set, ["h1", "h2"]).filter("row <> first_row").select(F.col("row").alias(row_col))
