"""Spatial correspondence (J4-J7) and the footprint/address merge.

Layers are conformed tables: ``id, provider, classification, address, height,
levels, geometry`` plus an optional ``foreign`` reference list and an
optional ``fips``. When both sides carry ``fips`` every join is also keyed on
it, so all counties are processed in one plan.

Rows are identified by ``(fips, provider, id)`` (Q19): ids are only unique
within a provider.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import st_centroid_xy, st_distance_once, st_overlap, st_point, with_bbox
from ..functions.plus_codes import plus_code
from ..functions.projection import albers_inverse
from ..functions.text import normalize_address
from ..schema import FOREIGN
from .spatial_join import candidate_pairs, dwithin_join, suffixed

ATTRS = ("classification", "address", "height", "levels")
BASE_COLS = ("id", "provider", "classification", "address", "height", "levels", "foreign", "geometry")
BBOX = ("xmin", "ymin", "xmax", "ymax")

Materialize = Callable[[DataFrame], DataFrame]


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage with a parquet table written under ``spark.checkpoint.dir``.

    A correspondence result is read three times (matched rows plus two anti
    joins); without the cut each fold step would recompute the spatial join
    and the plan would double per step. A written table costs one job (an
    eager RDD checkpoint computes the rows twice: count, then write), lives
    in the cluster's shared checkpoint folder (it survives lost executors)
    and reads back with column pruning.
    """
    import uuid

    from ..session import ensure_checkpoint_dir
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/footmark-tables/{uuid.uuid4().hex}"
    if _owners():
        _owners()[-1].tables.append((spark, path))  # first: what a failed write leaves goes too
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_LOCAL = threading.local()


def _owners() -> list[TableScope]:
    """The scopes entered in this thread, the innermost last."""
    if not hasattr(_LOCAL, "owners"):
        _LOCAL.owners = []
    return _LOCAL.owners


class TableScope:
    """Owns the tables that :func:`checkpoint` writes while it is the innermost scope of the thread, and
    deletes them when it is left, by an error too. What reads them must be written before."""

    def __init__(self):
        self.tables: list[tuple[SparkSession, str]] = []

    def __enter__(self) -> TableScope:
        _owners().append(self)
        return self

    def __exit__(self, *error) -> None:
        _owners().remove(self)
        for spark, path in self.tables:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def settled(build: Callable[[], DataFrame], materialize: Materialize = checkpoint) -> DataFrame:
    """The materialised result of ``build()``, without the tables that were written on the way to it.

    The result itself belongs to the scope around, if there is one."""
    if materialize is not checkpoint:
        return materialize(build())
    with TableScope() as inner:
        df = build()
        _owners().remove(inner)
        try:
            return checkpoint(df)
        finally:
            _owners().append(inner)


def no_materialize(df: DataFrame) -> DataFrame:
    return df


def empty_foreign() -> Column:
    """An empty ``array<struct<provider, key>>``."""
    return F.expr("cast(array() as array<struct<provider:string,key:string>>)")


def with_foreign(df: DataFrame) -> DataFrame:
    """P5: make sure ``foreign`` exists and is never null (empty typed list)."""
    if "foreign" in df.columns:
        return df.withColumn("foreign", F.coalesce(F.col("foreign"), empty_foreign()))
    return df.withColumn("foreign", empty_foreign())


def _keys(left: DataFrame, right: DataFrame) -> list[str]:
    return ["fips"] if ("fips" in left.columns and "fips" in right.columns) else []


def _base(df: DataFrame, keys: list[str]) -> DataFrame:
    """Base columns + the geometry's box (computed only if the layer lacks it) + keys."""
    if not all(c in df.columns for c in BBOX):
        df = with_bbox(df)
    return with_foreign(df).select(*BASE_COLS, *BBOX, *keys)


def reference(provider: Column, key: Column) -> Column:
    """struct(provider, key)."""
    return F.struct(provider.cast("string").alias("provider"), key.cast("string").alias("key"))


def anti_join(origin: DataFrame, matched: DataFrame, origin_keys: list[str], matched_keys: list[str],
              keys: list[str]) -> DataFrame:
    """Rows of ``origin`` with no match, shaped to the base columns.

    Rows with a null key never match and are kept; they bypass the join, so a
    layer where many rows lack an id does not pile them into one shuffle
    partition. The keys are shuffled, never broadcast: a table of them takes many
    times its compressed files in the driver.
    """
    # distinct keys: map-side partial aggregation, so a row matched by very many
    # pairs does not become a hot key; the join reuses this exchange
    m = matched.select(*[F.col(a).alias(f"__m{i}") for i, a in enumerate(keys + matched_keys)]).distinct()
    cond = None
    any_null = None
    for i, a in enumerate(keys + origin_keys):
        c = F.col(a) == F.col(f"__m{i}")
        cond = c if cond is None else cond & c
        n = F.col(a).isNull()
        any_null = n if any_null is None else any_null | n
    cols = [*BASE_COLS, *[c for c in BBOX if c in origin.columns], *keys]
    kept = origin.filter(~any_null).join(m.hint("merge"), cond, "left_anti").unionByName(origin.filter(any_null))
    return with_foreign(kept).select(*cols)


def overlap_metric(pairs: DataFrame, threshold: float = 0.3, column: str = "corresponds") -> DataFrame:
    """Overlap test on candidate pairs (``geometry_left`` / ``geometry_right``).

    area_intersection = area(left ∩ right); area_relative = the smaller of the
    two areas; metric = ratio; match when metric > threshold (strict). A pair
    whose smaller area is 0 has metric NaN (0/0), and NaN compares greater
    than any number, so a point inside a polygon matches (Q17). Pairs that do
    not intersect at all are dropped first (J1).
    """
    o = st_overlap(F.col("geometry_left"), F.col("geometry_right"))
    p = pairs.withColumn("__o", o).filter(F.col("__o.intersects"))
    rel = F.least(F.col("__o.area_left"), F.col("__o.area_right"))
    p = p.withColumn("area_intersection", F.col("__o.area_intersection")) \
        .withColumn("area_relative", rel) \
        .withColumn("metric", F.when(F.col("area_relative") == 0, F.lit(float("nan")))
                    .otherwise(F.col("area_intersection") / F.col("area_relative"))) \
        .drop("__o")
    return p.withColumn(column, F.col("metric") > F.lit(float(threshold)))


def distance_metric(pairs: DataFrame, threshold: float = 10.0, column: str = "corresponds", left: str = "geometry_left",
                    right: str = "geometry_right") -> DataFrame:
    """``metric`` (distance of the two geometry columns) and whether it is below ``threshold`` (strict).

    With box columns (``xmin_left`` ...) on the pairs, pairs of points are measured in the JVM, since a
    point is its own box; only the others go to the distance kernel. A null geometry gives null for both.
    A ``metric`` that is there already is taken as it is.
    """
    if "metric" not in pairs.columns:
        if all(f"{c}{s}" in pairs.columns for c in BBOX for s in ("_left", "_right")):
            x, y = F.col("xmin_left") - F.col("xmin_right"), F.col("ymin_left") - F.col("ymin_right")
            points = F.lit(True)
            for s in ("_left", "_right"):
                points = points & (F.col(f"xmin{s}") == F.col(f"xmax{s}")) & (F.col(f"ymin{s}") == F.col(f"ymax{s}"))
            rest = st_distance_once(F.when(~points, F.col(left)), F.when(~points, F.col(right)))
            pairs = pairs.withColumn("metric", F.when(points, F.sqrt(x * x + y * y)).otherwise(rest))
        else:
            pairs = pairs.withColumn("metric", st_distance_once(F.col(left), F.col(right)))
    return pairs.withColumn(column, F.col("metric") < F.lit(float(threshold)))


def correspondence_pairs(left: DataFrame, right: DataFrame, *, use_distance: bool = False,
                         threshold: float | None = None, cell: float = 50.0,
                         levels=None) -> DataFrame:
    """Matching (left, right) pairs with ``metric`` and ``_left`` / ``_right`` columns."""
    keys = _keys(left, right)
    L = _base(left, keys)
    R = _base(right, keys)
    if use_distance:
        t = 10.0 if threshold is None else threshold
        pairs = candidate_pairs(suffixed(L, "_left"), suffixed(R, "_right"), keys=tuple(keys), grow=t, cell=cell, levels=levels)
        return distance_metric(pairs, t).filter("corresponds")
    t = 0.3 if threshold is None else threshold
    Lb = suffixed(L, "_left")
    Rb = suffixed(R, "_right")
    pairs = candidate_pairs(Lb, Rb, keys=tuple(keys), cell=cell, levels=levels)
    return overlap_metric(pairs, t).filter("corresponds")


def spatial_correspondence(left: DataFrame, right: DataFrame, *, use_distance: bool = False,
                           threshold: float | None = None, cell: float = 50.0,
                           multi: str = "pairs", materialize: Materialize = checkpoint,
                           levels=None) -> DataFrame:
    """Merge ``right`` into ``left``: matched pairs ∪ left-only ∪ right-only.

    Pairs match by overlap (> 0.3 of the smaller area) or, with
    ``use_distance``, by distance (< 10 m). For a pair, id, provider and
    geometry come from the left row; classification, address, height and
    levels from the left row, else the right row; ``foreign`` = left.foreign
    ++ right.foreign ++ [right's (provider, id)].

    multi="pairs" (default, literal Q10): one output row per matching pair, so
    a left row with two matches appears twice. multi="collapse": one row per
    left row, the best match's attributes and all matches' references (best
    metric first).

    The matched pairs are materialised once (``materialize``, a checkpoint by
    default) since they feed the output and both anti joins.
    """
    keys = _keys(left, right)
    pairs = correspondence_pairs(left, right, use_distance=use_distance, threshold=threshold,
                                 cell=cell, levels=levels)
    coalesced = [F.coalesce(F.col(f"{a}_left"), F.col(f"{a}_right")).alias(a) for a in ATTRS]
    new_ref = F.array(reference(F.col("provider_right"), F.col("id_right")))
    if multi == "pairs":
        matched = pairs.select(
            F.col("id_left").alias("id"),
            F.col("provider_left").alias("provider"),
            *coalesced,
            F.concat(F.col("foreign_left"), F.col("foreign_right"), new_ref).alias("foreign"),
            F.col("geometry_left").alias("geometry"),
            *[F.col(f"{c}_left").alias(c) for c in BBOX],
            *[F.col(f"{k}_left").alias(k) for k in keys],
            F.col("id_right").alias("__rid"),
            F.col("provider_right").alias("__rprov"),
        )
    elif multi == "collapse":
        order = F.col("metric") if use_distance else -F.col("metric")
        g = pairs.groupBy(*[f"{k}_left" for k in keys], "provider_left", "id_left").agg(
            F.min(F.struct(order.alias("o"), *[F.col(c) for c in pairs.columns])).alias("best"),
            F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col("provider_right").alias("p"),
                                                 F.col("id_right").alias("k")))).alias("refs"))
        # one row per left id: the reference list of all matches, best first
        b = "best."
        matched = g.select(
            F.col(b + "id_left").alias("id"),
            F.col(b + "provider_left").alias("provider"),
            *[F.coalesce(F.col(f"{b}{a}_left"), F.col(f"{b}{a}_right")).alias(a) for a in ATTRS],
            F.concat(F.col(b + "foreign_left"), F.col(b + "foreign_right"),
                     F.transform("refs", lambda r: reference(r["p"], r["k"]))).alias("foreign"),
            F.col(b + "geometry_left").alias("geometry"),
            *[F.col(f"{b}{c}_left").alias(c) for c in BBOX],
            *[F.col(f"{b}{k}_left").alias(k) for k in keys],
            F.col(b + "id_right").alias("__rid"),
            F.col(b + "provider_right").alias("__rprov"),
        )
        # every right row that matched counts as matched, not only the best one
        matched_right = pairs.select(*[F.col(f"{k}_right").alias(k) for k in keys],
                                     F.col("provider_right").alias("__rprov"),
                                     F.col("id_right").alias("__rid"))
    else:
        raise ValueError(f"unknown multi mode {multi!r}")
    matched = materialize(matched)
    L, R = _base(left, keys), _base(right, keys)
    left_missing = anti_join(L, matched, ["provider", "id"], ["provider", "id"], keys)
    right_src = matched if multi == "pairs" else materialize(matched_right)
    right_missing = anti_join(R, right_src, ["provider", "id"], ["__rprov", "__rid"], keys)
    out = matched.select(*BASE_COLS, *BBOX, *keys)
    return out.unionByName(left_missing).unionByName(right_missing)


def fold_correspondence(layers: list[DataFrame], materialize: Materialize = checkpoint, **kw) -> DataFrame:
    """Fold J7 over an ordered list of layers: ((l0 ← l1) ← l2) ← ...

    Each intermediate result is materialised: the next step reads it twice,
    so without the cut the plan (and the work) would double per step.
    """
    acc = layers[0]
    for i, nxt in enumerate(layers[1:]):
        if i > 0:
            acc = materialize(acc)
        acc = spatial_correspondence(acc, nxt, materialize=materialize, **kw)
    return acc


def merge_footprints_and_addresses(footprints: DataFrame, addresses: DataFrame, *,
                                   threshold: float = 10.0, cell: float = 50.0,
                                   collapse_null_address: bool = False,
                                   materialize: Materialize = checkpoint,
                                   levels=None) -> DataFrame:
    """Attach addresses to footprints and mint one entity per building/address.

    1. every address within ``threshold`` (< 10 m) of a footprint is a
       candidate; per footprint only the nearest address(es) are kept (ties
       kept, F7/W1);
    2. a matched row takes id/provider from the address, attributes address
       first, ``foreign`` = address.foreign ++ footprint.foreign ++
       [footprint reference], geometry = the address point when it lies on the
       footprint (distance 0), else the footprint;
    3. ∪ unmatched footprints ∪ unmatched addresses;
    4. addresses normalised (T6), geometry reduced to its centroid;
    5. one row per normalised address (per fips): the one first by
       (provider, id) (W3, Q14 tie-break by id); rows with a null address are
       each their own entity unless ``collapse_null_address`` (literal Q13);
    6. one row per (provider, id) (D2); a self reference is appended to
       ``foreign``; id := 13-digit plus code of the point (G9); provider dropped.

    Step 1 works on keys, places and distances alone (:func:`nearest_places`); payloads join the
    nearest pairs only. Steps 1 and 5-6 are aggregations (partial, map-side), not windows, so a
    footprint or address shared by a large share of rows is reduced before
    the shuffle.
    """
    keys = _keys(footprints, addresses)
    Fp = _base(footprints, keys)
    Ad = _base(addresses, keys)
    near = materialize(nearest_places(Fp, Ad, keys, threshold, cell, levels, materialize))
    pairs = near.hint("merge").join(suffixed(Ad.drop(*BBOX), "_right"), _same({f"{k}_left": f"{k}_right" for k in keys} | {"place": "geometry_right"})) \
        .join(suffixed(Fp.drop(*BBOX).withColumn("shape", F.xxhash64("geometry")), "_fp").hint("merge"),
              _same({f"{c}_left": f"{c}_fp" for c in [*keys, "provider", "id", "shape"]})) \
        .select("metric", *[f"{c}_right" for c in (*BASE_COLS, *keys)], *[F.col(f"{c}_fp").alias(f"{c}_left") for c in (*BASE_COLS, *keys)])
    matched = pairs.select(
        F.col("id_right").alias("id"),
        F.col("provider_right").alias("provider"),
        *[F.coalesce(F.col(f"{a}_right"), F.col(f"{a}_left")).alias(a) for a in ATTRS],
        F.concat(F.col("foreign_right"), F.col("foreign_left"),
                 F.array(reference(F.col("provider_left"), F.col("id_left")))).alias("foreign"),
        F.when(F.col("metric") == 0, F.col("geometry_right")).otherwise(F.col("geometry_left"))
        .alias("geometry"),
        *[F.col(f"{k}_right").alias(k) for k in keys],
        F.col("id_left").alias("__fid"),
        F.col("provider_left").alias("__fprov"),
    )
    matched = materialize(matched)
    fp_missing = anti_join(Fp, matched, ["provider", "id"], ["__fprov", "__fid"], keys).drop(*BBOX)
    ad_missing = anti_join(Ad, matched, ["provider", "id"], ["provider", "id"], keys).drop(*BBOX)
    allrows = matched.select(*BASE_COLS, *keys).unionByName(fp_missing).unionByName(ad_missing)
    # one decode: centroid coordinates, then the point is encoded from them
    allrows = allrows.withColumn("address", normalize_address(F.col("address"))) \
        .withColumn("__xy", st_centroid_xy(F.col("geometry"))) \
        .withColumn("x", F.col("__xy.x")).withColumn("y", F.col("__xy.y")) \
        .withColumn("geometry", st_point(F.col("x"), F.col("y"))).drop("__xy")
    # read twice (rows with and without an address): written once, so the address grammar is
    # planned and the anti joins run a single time
    return finish_entities(materialize(allrows), keys, collapse_null_address)


def _same(names: dict[str, str]) -> Column:
    """All named columns equal, null to null."""
    out = F.lit(True)
    for a, b in names.items():
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def nearest_places(footprints: DataFrame, addresses: DataFrame, keys: list[str], threshold: float, cell: float = 50.0,
                   levels=None, materialize: Materialize = checkpoint) -> DataFrame:
    """For each footprint the nearest address place(s) below ``threshold``, ties kept.

    Rows are ``provider_left, id_left, shape_left`` (a hash of the footprint's geometry, for ids that
    repeat), the ``keys``, ``place`` (the address geometry) and ``metric``: no payload. Addresses at
    one place are one node and repeated footprints one row, so many rows at a place don't make all
    pairs; the minimum is a partial aggregation over these narrow rows.
    """
    places = addresses.filter(F.col("geometry").isNotNull()).select(*keys, "geometry", *BBOX).dropDuplicates([*keys, "geometry"])
    shapes = footprints.filter(F.col("geometry").isNotNull()).select(*keys, "provider", "id", "geometry", *BBOX) \
        .dropDuplicates([*keys, "provider", "id", "geometry"]).withColumn("shape", F.xxhash64("geometry"))
    # the place is the probe (grown by the threshold)
    pairs = dwithin_join(places, shapes, distance=threshold, keys=tuple(keys), cell=cell, lsfx="_right", rsfx="_left", levels=levels)
    own = [f"{k}_left" for k in keys] + ["provider_left", "id_left"]
    pairs = materialize(pairs.select(*own, "shape_left", F.col("geometry_right").alias("place"), "metric"))
    least = pairs.groupBy(*own).agg(F.min("metric").alias("least")).select(*[F.col(c).alias(f"{c}_least") for c in own], "least")
    return pairs.join(least.hint("merge"), _same({c: f"{c}_least" for c in own})).filter(F.col("metric") == F.col("least")) \
        .select(*own, "shape_left", "place", "metric")


def finish_entities(allrows: DataFrame, keys: list[str], collapse_null_address: bool = False) -> DataFrame:
    """Steps 5-6 of :func:`merge_footprints_and_addresses` (dedupe, self reference, plus code).

    Ties are broken by (provider, id, classification, height, levels,
    foreign, x, y), nulls first; the point coordinates rather than the WKB
    bytes, so the order is numeric.
    """
    if "x" not in allrows.columns:
        allrows = allrows.withColumn("__xy", st_centroid_xy(F.col("geometry"))) \
            .withColumn("x", F.col("__xy.x")).withColumn("y", F.col("__xy.y")).drop("__xy")
    payload = ["classification", "height", "levels", "foreign", "x", "y", "geometry"]
    first = F.min(F.struct("provider", "id", *payload)).alias("r")
    addr = allrows.filter(F.col("address").isNotNull())
    nulls = allrows.filter(F.col("address").isNull())
    by_addr = addr.groupBy(*keys, "address").agg(first).select(*keys, "address", "r.*")
    if collapse_null_address:
        nulls = nulls.groupBy(*keys).agg(first).select(*keys, F.lit(None).cast("string").alias("address"), "r.*")
    rows = by_addr.unionByName(nulls.select(*keys, "address", "provider", "id", *payload))
    # One row per (provider, id)
    rows = rows.groupBy(*keys, "provider", "id").agg(
        F.min(F.struct("address", *payload)).alias("r")).select(*keys, "provider", "id", "r.*")
    lon, lat = albers_inverse(F.col("x"), F.col("y"))
    return rows.select(
        plus_code(lat, lon).alias("id"),
        "classification", "address", "height", "levels",
        F.concat(F.col("foreign"), F.array(reference(F.col("provider"), F.col("id")))).alias("foreign"),
        "geometry", "x", "y",
        *keys,
    )
