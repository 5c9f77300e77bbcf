"""Near-duplicate vectors by Euclidean p-stable hashing.

Unit vectors are projected on Gaussian directions; floor((a.v + b) / WIDTH) of several directions
make one bucket key, several such tables give candidates, and the cosine of candidates is computed
in double precision. The number of directions grows with the logarithm of the rows of a label (so
that chance collisions stay rare at any size), the number of tables follows from the bound on the
probability to miss a pair exactly at the threshold.

Equal vectors collapse first. Buckets with one member are dropped before any vector moves. A bucket
of any size is cut into blocks, and pairs of blocks are spread over tasks, which emit for each vector
the number of its links and, for connectivity, at most one edge a vector: never the pairs. A pair
that meets in several tables is counted in the first of them only.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footmark.llm.common import cut, mix, partitions, prepare
from footmark.llm.components import components
from footmark.llm.vectors import matrices, unit_rows

COSINE = 0.98
WIDTH = 1.6
#: Bound on the probability that a pair exactly at the threshold shares no bucket.
MISS = 1e-5
#: Rows of a block of a bucket.
BLOCK = 1024
SEED = 20240613


def collision(distance: float, width: float = WIDTH) -> float:
    """Probability that one projection puts two points at this distance in one cell."""
    r = width / distance
    return math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan_tables(rows: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(directions a table, tables): unrelated unit vectors (a right angle apart) meet less than
    once a row and table, and the miss bound holds."""
    near, far = collision(math.sqrt(max(2 - 2 * cosine, 1e-12))), collision(math.sqrt(2))
    k = max(4, math.ceil(math.log(max(rows, 2)) / -math.log(far)) + 2)
    return k, max(1, math.ceil(math.log(miss) / math.log1p(-near ** k)))


def _key_batches(batches, k, tables):
    rng: dict = {}
    for batch in batches:
        for at, m in matrices(batch.column(1)):
            d = m.shape[1]
            if d not in rng:
                g = np.random.default_rng([SEED, d])
                rng[d] = g.standard_normal((d, k * tables)), g.uniform(0, WIDTH, k * tables)
            direction, offset = rng[d]
            unit = unit_rows(m)
            cell = np.floor((unit @ direction + offset) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(m), tables, k)
            label = batch.column(2).take(pa.array(at)).to_numpy().astype(np.int64).view(np.uint64)
            key = mix(label[:, None] + np.arange(tables, dtype=np.uint64)[None, :] * np.uint64(0x9FB21C651E98DF25) + np.uint64(d))
            for j in range(k):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + cell[:, :, j])
            ids = batch.column(0).take(pa.array(at))
            yield pa.record_batch([ids, pa.array(list(key.view(np.int64)), pa.list_(pa.int64()))], names=["cls", "keys"])


def _compare(rows, cosine):
    """(cls, links, root) of one group: rows of one bucket's block pair."""
    cls, node, n, blk, left, right, table, unit, keys = rows
    if left == right:
        a = b = np.arange(len(cls))
    else:
        a, b = np.flatnonzero(blk == left), np.flatnonzero(blk == right)
    if not len(a) or not len(b):
        return None
    linked = unit[a] @ unit[b].T >= cosine
    if left == right:
        np.fill_diagonal(linked, False)
    if not linked.any():
        return None
    x, y = np.nonzero(linked)
    fresh = np.ones(len(x), dtype=bool)
    for t in range(table):  # met before: counted there
        fresh &= keys[a[x], t] != keys[b[y], t]
    links = np.bincount(a[x], n[b[y]] * fresh, minlength=len(cls))
    if left != right:
        links += np.bincount(b[y], n[a[x]] * fresh, minlength=len(cls))
    root = np.arange(len(cls))
    p, q = a[x], b[y]
    while True:
        low = np.minimum(root[p], root[q])
        new = root.copy()
        np.minimum.at(new, p, low)
        np.minimum.at(new, q, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    met = np.zeros(len(cls), dtype=bool)
    met[p] = met[q] = True
    return cls[met], links[met].astype(np.int64), node[met], node[root[met]]


def _link_batches(batches, cosine):
    held = None

    def groups(t, final):
        """Emit all groups but the last (which the next batch may continue), and return that."""
        key = t.column("key").to_numpy()
        lo, hi = t.column("lo").to_numpy(), t.column("hi").to_numpy()
        new = np.append(True, (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]))
        cuts = np.append(np.flatnonzero(new), len(key))
        if not final:
            cuts = cuts[:-1]
        out = [[], [], [], []]
        if len(cuts) > 1:
            cls, node, n, blk, table = (t.column(c).to_numpy() for c in ("cls", "node", "n", "blk", "table"))
            keys = t.column("keys").combine_chunks().flatten().to_numpy().reshape(len(key), -1)
            unit: list = [None] * len(key)
            for at, m in matrices(t.column("vec").combine_chunks()):
                for i, v in zip(at, unit_rows(m)):
                    unit[i] = v
            for s, e in zip(cuts[:-1], cuts[1:]):
                if e - s < 2:
                    continue
                got = _compare((cls[s:e], node[s:e], n[s:e], blk[s:e], lo[s], hi[s], int(table[s]), np.array(unit[s:e]), keys[s:e]), cosine)
                if got:
                    for o, g in zip(out, got):
                        o.append(g)
        rest = t.slice(int(cuts[-1])) if len(cuts) else t
        done = pa.record_batch([pa.array(np.concatenate(o) if o else np.zeros(0, np.int64)) for o in out],
                               names=["cls", "links", "node", "root"])
        return done, rest

    for batch in batches:
        t = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, t]) if held is not None and held.num_rows else t
        done, held = groups(held, False) if held.num_rows else (None, held)
        if done is not None and done.num_rows:
            yield done
    if held is not None and held.num_rows:
        yield groups(held, True)[0]


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *,
                 cosine: float = COSINE) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Rows link when their labels are equal and the cosine of their vectors is ``cosine`` or more.
    n_links counts the other rows linked directly; component_id is the smallest id reachable.
    Rows with a null id or label and vectors that are null, empty, zero or hold null or non-finite
    components link with nothing (component_id is the id, kept is true); finite vectors of any scale
    link by direction alone; vectors of different lengths never link; repeated rows are rows of their own that link with each other, under one
    id in components; an empty table gives no rows."""
    spark = rows.sparkSession
    prepare(spark)
    v = F.col("vec")
    src = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                      F.col(vector_col).cast("array<double>").alias("vec"))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() \
        & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    usable = F.coalesce(usable, F.lit(False))
    narrow = cut(src.select("vec_id", F.when(usable, F.col("label")).alias("label"), F.xxhash64("vec", "label").alias("h1"),
                            F.xxhash64("label", "vec").alias("h2")), "vectors")
    classes = src.filter(usable).groupBy("label", F.xxhash64("vec", "label").alias("h1"), F.xxhash64("label", "vec").alias("h2")) \
        .agg(F.min("vec_id").alias("node"), F.count("*").alias("n"), F.first("vec").alias("vec"))
    classes = cut(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    k, tables = plan_tables(most, cosine)
    keys = cut(classes.select("cls", "vec", "label").mapInArrow(partial(_key_batches, k=k, tables=tables), "cls long, keys array<long>"), "keys")
    keyed = keys.select("cls", F.posexplode("keys").alias("table", "key"))
    shared = cut(keyed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "shared")
    members = keyed.join(shared, "key")
    blocks = F.ceil(F.col("size") / BLOCK)
    blk = F.pmod(F.xxhash64("cls"), blocks)
    pairs = members.withColumn("blocks", blocks).withColumn("blk", blk) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pairs = pairs.select("key", "table", "cls", "blk", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi"))
    work = pairs.join(classes.select("cls", "node", "n", "vec").join(keys, "cls"), "cls") \
        .repartition(partitions(spark), "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi") \
        .select("key", "lo", "hi", "table", "cls", "node", "n", "blk", "vec", "keys")
    links = cut(work.mapInArrow(partial(_link_batches, cosine=cosine), "cls long, links long, node long, root long"), "links")
    comp = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    count = links.groupBy("cls").agg(F.sum("links").alias("links"))
    by_class = cut(classes.select("label", "h1", "h2", "cls", "node", "n").join(count, "cls", "left")
                   .join(comp.withColumnRenamed("node", "c_node"), F.col("node") == F.col("c_node"), "left")
                   .select("label", "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                           F.coalesce("component", "node").alias("component_id")), "by_class")
    out = narrow.join(by_class, ["label", "h1", "h2"], "left")
    comp_id = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), comp_id.alias("component_id"),
                      F.coalesce(F.col("vec_id") == comp_id, F.lit(True)).alias("kept"))
