"""Spatial joins as grid-cell equi-joins.

Catalyst plans a join on a bounding-box condition alone as a nested-loop
join. Here each side is expanded to the grid cells its box covers and the
join key is ``(keys..., level, cx, cy)``, so Spark plans an ordinary hash /
sort-merge join, shuffles by cell and spreads the work over the cluster.

Multi-level grid
----------------
Each geometry lives on the coarsest-needed level ``L`` where the cell size
``cell * 2**L`` is at least its (grown) box size, so it covers at most 2 x 2
cells there. To meet a geometry of a higher level, a row is also emitted
("up" rows) on the coarser levels that the other side occupies; levels without
a row of the other side get none. Footprints and address points sit on level
0; a county polygon goes a dozen levels up and costs the same few rows.

The join key holds a ``slot`` beside the cell: home rows meet home rows in slot
0, up rows of one side meet the home rows of the other in slots of their own,
so each pair is found on exactly one level and two up rows never meet. A cell
far above the small rows can hold all of them. There the up rows are salted
over several slots and the few large home rows are repeated in each of them.

Duplicates across cells are removed with the reference-point rule (Dittrich &
Seeger, ICDE 2000): a pair is reported only in the cell that holds the lower
corner of the intersection of the two boxes. No ``distinct`` is needed.

Both sides are shuffled and sorted, whatever size the planner expects: it takes a layer for as small as
the few compressed columns that it is made from, and would send millions of rows with their geometries
through the driver as a broadcast.

Skew: a hot cell of the lowest level (many features at one point) lands in one
shuffle partition; adaptive execution's skew-join handling splits that
partition and replicates the matching side, so no task holds a whole hot
group. All filters up to the exact test are JVM expressions; only surviving
candidates reach the Arrow UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import st_distance_once, st_intersects, with_bbox

DEFAULT_CELL = 50.0
MAX_LEVEL = 40
#: Up rows are salted from this many levels above the lowest one of their side (16 x 16 cells).
SALT_GAP = 4
MAX_SALT = 64

Levels = tuple[frozenset[int], frozenset[int]]


def _level(xmin: Column, ymin: Column, xmax: Column, ymax: Column, cell: float) -> Column:
    ext = F.greatest(xmax - xmin, ymax - ymin)
    lv = F.ceil(F.log2(F.greatest(ext, F.lit(cell)) / F.lit(cell)))
    return F.least(F.greatest(lv, F.lit(0)), F.lit(MAX_LEVEL)).cast("int")


def _grown(sfx: str, grow: float) -> list[Column]:
    xmin, ymin, xmax, ymax = (F.col(f"{c}{sfx}") for c in ("xmin", "ymin", "xmax", "ymax"))
    g = F.lit(float(grow))
    return [xmin - g, ymin - g, xmax + g, ymax + g]


def salts(level: int, lowest: int) -> int:
    """Slots over which up rows of a side whose lowest level is ``lowest`` are spread on ``level``."""
    return 1 if level - lowest < SALT_GAP else min(MAX_SALT, 2 ** (level - lowest - SALT_GAP + 2))


def _cells(box: list[Column], home: Column, own: frozenset[int], other: frozenset[int], side: int,
           cell: float) -> Column:
    """array<struct<lvl, cx, cy, slot>>: the cells of one box on its home level and, as an up row,
    on the higher levels that the other side occupies. ``side`` (1 or -1) keeps the up rows of the
    two sides in different slots."""
    xmin, ymin, xmax, ymax = box
    low, other_low = min(own, default=0), min(other, default=0)

    def covered(lv, slots):
        size = F.lit(cell) * F.pow(F.lit(2.0), lv)
        x0, x1 = F.floor(xmin / size), F.floor(xmax / size)
        y0, y1 = F.floor(ymin / size), F.floor(ymax / size)
        return F.flatten(F.transform(F.sequence(x0, x1), lambda cx: F.flatten(F.transform(
            F.sequence(y0, y1), lambda cy: F.transform(slots, lambda s: F.struct(
                lv.alias("lvl"), cx.alias("cx"), cy.alias("cy"), s.alias("slot")))))))

    # home row: slot 0, and every slot in which up rows of the other side can wait on this level
    home_slots = F.array(F.lit(0))
    for lv in sorted(own):
        if other and lv > other_low:
            wait = [F.lit(-side * (k + 1)) for k in range(salts(lv, other_low))]
            home_slots = F.when(home == lv, F.array(F.lit(0), *wait)).otherwise(home_slots)
    out = covered(home, home_slots)
    higher = [lv for lv in sorted(other) if lv > low]
    if not higher:
        return out
    spread = F.xxhash64(xmin, ymin, xmax, ymax)
    ups = F.array(*[F.struct(F.lit(lv).alias("l"),
                             (F.lit(side) * (F.pmod(spread, F.lit(salts(lv, low))).cast("int") + 1)).alias("s"))
                    for lv in higher])
    return F.concat(out, F.flatten(F.transform(F.filter(ups, lambda u: u["l"] > home),
                                               lambda u: covered(u["l"], F.array(u["s"])))))


def occupied_levels(df: DataFrame, grows: tuple[float, ...] = (0.0,), by: str = "provider",
                    cell: float = DEFAULT_CELL) -> dict:
    """Grid levels that occur per ``by`` value, for each of ``grows``: {grow: {value: levels}}.

    One aggregate over the box columns; at most MAX_LEVEL + 1 levels a value."""
    aggs = [F.collect_set(_level(*_grown("", g), cell)).alias(f"g{i}") for i, g in enumerate(grows)]
    rows = df.filter(F.col("xmin").isNotNull()).groupBy(by).agg(*aggs).collect()
    return {g: {r[0]: frozenset(r[i + 1]) for r in rows} for i, g in enumerate(grows)}


def _levels_of(L: DataFrame, R: DataFrame) -> Levels:
    """Occupied levels of both sides in one job."""
    found = L.select(F.lit(0).alias("side"), F.col("__lhome").alias("lvl")).unionAll(
        R.select(F.lit(1).alias("side"), F.col("__rhome").alias("lvl"))).distinct().collect()
    return (frozenset(r.lvl for r in found if r.side == 0), frozenset(r.lvl for r in found if r.side == 1))


def candidate_pairs(left: DataFrame, right: DataFrame, *, lsfx: str = "_left", rsfx: str = "_right",
                    keys: tuple[str, ...] = (), grow: float = 0.0, cell: float = DEFAULT_CELL,
                    levels: Levels | None = None) -> DataFrame:
    """All (left, right) pairs whose boxes overlap, the left box grown by ``grow``.

    Both sides must carry ``xmin/ymin/xmax/ymax`` with their suffix (see
    :func:`~footmark.functions.geometry.with_bbox`) and the ``keys`` columns
    (e.g. ``fips``) with their suffix; pairs must agree on every key. Rows
    with a null box never pair. Output: all columns of both sides.

    ``levels`` gives the levels that occur in (left, right), left ones with ``grow`` (see
    :func:`occupied_levels`; more than occur does no harm); when None they are read from the data.
    """
    lgrown, rb = _grown(lsfx, grow), _grown(rsfx, 0.0)
    L = left.filter(F.col(f"xmin{lsfx}").isNotNull()).withColumn("__lhome", _level(*lgrown, cell))
    R = right.filter(F.col(f"xmin{rsfx}").isNotNull()).withColumn("__rhome", _level(*rb, cell))
    llv, rlv = levels if levels is not None else _levels_of(L, R)

    at = ("lvl", "cx", "cy", "slot")
    L = L.withColumn("__lc", F.explode(_cells(lgrown, F.col("__lhome"), llv, rlv, 1, cell))) \
        .select("*", *[F.col(f"__lc.{c}").alias(f"__{c}") for c in at]).drop("__lc", "__lhome")
    R = R.withColumn("__rc", F.explode(_cells(rb, F.col("__rhome"), rlv, llv, -1, cell))) \
        .select("*", *[F.col(f"__rc.{c}").alias(f"__r{c}") for c in at]).drop("__rc", "__rhome")

    cond = F.lit(True)
    for c in at:
        cond = cond & (F.col(f"__{c}") == F.col(f"__r{c}"))
    for k in keys:
        cond = cond & (F.col(f"{k}{lsfx}") == F.col(f"{k}{rsfx}"))
    j = L.join(R.hint("merge"), cond, "inner")

    size = F.lit(cell) * F.pow(F.lit(2.0), F.col("__lvl"))
    refx = F.greatest(lgrown[0], rb[0])
    refy = F.greatest(lgrown[1], rb[1])
    keep = (lgrown[0] <= rb[2]) & (rb[0] <= lgrown[2]) & (lgrown[1] <= rb[3]) & (rb[1] <= lgrown[3]) & \
        (F.floor(refx / size) == F.col("__cx")) & (F.floor(refy / size) == F.col("__cy"))
    return j.filter(keep).drop(*[f"__{c}" for c in at], *[f"__r{c}" for c in at])


def suffixed(df: DataFrame, sfx: str) -> DataFrame:
    """Rename every column to ``name + sfx``."""
    return df.select([F.col(c).alias(f"{c}{sfx}") for c in df.columns])


def ensure_bbox(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    if all(c in df.columns for c in ("xmin", "ymin", "xmax", "ymax")):
        return df
    return with_bbox(df, geometry)


def intersects_join(left: DataFrame, right: DataFrame, *, keys: tuple[str, ...] = (),
                    cell: float = DEFAULT_CELL, lsfx: str = "_left", rsfx: str = "_right",
                    geometry: str = "geometry", levels=None) -> DataFrame:
    """Every (left, right) pair whose geometries intersect (touching counts).

    Inputs are unsuffixed layers; output columns carry ``_left`` / ``_right``.
    A null geometry never matches (Q18).
    """
    L = suffixed(ensure_bbox(left, geometry), lsfx)
    R = suffixed(ensure_bbox(right, geometry), rsfx)
    c = candidate_pairs(L, R, lsfx=lsfx, rsfx=rsfx, keys=keys, cell=cell, levels=levels)
    return c.filter(st_intersects(F.col(f"{geometry}{lsfx}"), F.col(f"{geometry}{rsfx}")))


def dwithin_join(left: DataFrame, right: DataFrame, distance: float = 10.0, *,
                 keys: tuple[str, ...] = (), cell: float = DEFAULT_CELL, lsfx: str = "_left",
                 rsfx: str = "_right", geometry: str = "geometry", metric: str = "metric",
                 levels=None) -> DataFrame:
    """Every pair closer than ``distance`` (strict), with the distance as ``metric``.

    The reference's search is named "nearest" but returns every candidate
    under the threshold, not only the closest one (Q16); so does this.
    """
    L = suffixed(ensure_bbox(left, geometry), lsfx)
    R = suffixed(ensure_bbox(right, geometry), rsfx)
    c = candidate_pairs(L, R, lsfx=lsfx, rsfx=rsfx, keys=keys, grow=distance, cell=cell, levels=levels)
    c = c.withColumn(metric, st_distance_once(F.col(f"{geometry}{lsfx}"), F.col(f"{geometry}{rsfx}")))
    return c.filter(F.col(metric) < F.lit(float(distance)))
