"""Conflate job (C8): all counties in one plan.

footprints = J7 fold over the footprint providers (default openstreetmap ←
microsoft ← usa_structures, Q11); addresses = J7 by distance of nad ←
openaddresses (a missing layer simply contributes no rows, Q12); entities =
J8 merge. Outputs: entities, crossref, footprints (S7-S9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.correspondence import (Materialize, TableScope, checkpoint, merge_footprints_and_addresses, settled,
                                        spatial_correspondence)
from ..operators.spatial_join import DEFAULT_CELL, occupied_levels
from ..sources.io import crossref_table, entities_table, footprints_table

FOOTPRINT_ORDER = ("openstreetmap", "microsoft", "usa_structures")
ADDRESS_ORDER = ("nad", "openaddresses")


def provider_counts(conformed: DataFrame) -> DataFrame:
    """A1: rows per (fips, provider) in one aggregate (instead of one scan per provider)."""
    return conformed.groupBy("fips", "provider").agg(F.count(F.lit(1)).alias("n"))


def layer(conformed: DataFrame, provider: str) -> DataFrame:
    """one provider's rows (partition pruning on a partitioned scan)."""
    return conformed.filter(F.col("provider") == provider)


def grid_levels(conformed: DataFrame, grows=(0.0, 10.0), cell: float = DEFAULT_CELL) -> dict | None:
    """Occupied grid levels per provider and growth of its boxes, for every join of a conflation."""
    return occupied_levels(conformed, tuple(dict.fromkeys(grows)), cell=cell) if "xmax" in conformed.columns else None


def _levels(occupied: dict | None, left_providers, right_providers, grow: float = 0.0):
    """Levels of (left, right) from :func:`grid_levels`; None = read from the data."""
    if occupied is None:
        return None

    def of(providers, g):
        return frozenset().union(*[occupied[g].get(p, frozenset()) for p in providers])

    return of(left_providers, grow), of(right_providers, 0.0)


def conflate_footprints(conformed: DataFrame, order=FOOTPRINT_ORDER,
                        materialize: Materialize = checkpoint, occupied: dict | None = None,
                        cell: float = DEFAULT_CELL, **kw) -> DataFrame:
    """J7 fold over the footprint layers: ((osm ← microsoft) ← usa_structures)."""
    acc = layer(conformed, order[0])
    for i, p in enumerate(order[1:], start=1):
        if i > 1:
            acc = materialize(acc)   # the next step reads it twice (pairs and anti join)
        lv = _levels(occupied, order[:i], [p])
        acc = spatial_correspondence(acc, layer(conformed, p), materialize=materialize, cell=cell,
                                     levels=lv, **kw)
    return acc


def conflate_addresses(conformed: DataFrame, order=ADDRESS_ORDER,
                       materialize: Materialize = checkpoint, occupied: dict | None = None,
                       cell: float = DEFAULT_CELL, threshold: float = 10.0, **kw) -> DataFrame:
    """J7 by distance over the address layers: nad ← openaddresses."""
    acc = layer(conformed, order[0])
    for i, p in enumerate(order[1:], start=1):
        if i > 1:
            acc = materialize(acc)
        lv = _levels(occupied, order[:i], [p], threshold)
        acc = spatial_correspondence(acc, layer(conformed, p), use_distance=True, threshold=threshold,
                                     materialize=materialize, cell=cell, levels=lv, **kw)
    return acc


def conflate(conformed: DataFrame, footprint_order=FOOTPRINT_ORDER, address_order=ADDRESS_ORDER,
             materialize: Materialize = checkpoint, collapse_null_address: bool = False,
             cell: float = DEFAULT_CELL, multi: str | None = None, overlap: float | None = None,
             address_distance: float = 10.0, merge_distance: float = 10.0):
    """Returns (entities, crossref, footprints) DataFrames.

    ``overlap``: share of the smaller area above which footprints match; ``address_distance`` and
    ``merge_distance``: metres below which addresses match each other and a footprint; ``multi``:
    how several matches of one row are treated (see :func:`spatial_correspondence`).

    ``conformed`` is the stacked conformed layers (CONFORM + fips + provider,
    plus the box columns when present). The grid levels that occur per provider are
    read once (one small aggregate) and serve every join.
    Footprints are materialised once: they feed both the merge and the
    footprints table. The tables of the steps are removed after their last reader; two remain
    (footprints and merged rows), which the results read.
    """
    same = {} if multi is None else {"multi": multi}
    occupied = grid_levels(conformed, (0.0, float(address_distance), float(merge_distance)), cell)
    footprints = settled(lambda: conflate_footprints(conformed, footprint_order, materialize, occupied, cell, **same,
                                                     **({} if overlap is None else {"threshold": overlap})), materialize)
    lv = _levels(occupied, address_order, footprint_order, merge_distance)

    def merge():
        # the merge reads the addresses twice (pairs and anti join); their table goes after it
        addresses = settled(lambda: conflate_addresses(conformed, address_order, materialize, occupied, cell,
                                                       threshold=address_distance, **same), materialize)
        return merge_footprints_and_addresses(footprints, addresses, collapse_null_address=collapse_null_address,
                                              materialize=materialize, cell=cell, levels=lv, threshold=merge_distance)

    merged = settled(merge, materialize)
    return entities_table(merged), crossref_table(merged), footprints_table(footprints)


def conflate_job(spark, input_dir: str, output: str, fips=None, **kw):
    """C8 end to end: scan ``input_dir/conform`` (S6), conflate, write the three tables.

    ``fips`` optionally restricts the run to some counties (partition pruning
    on the scan). Every table written on the way is removed; returns (entities, crossref,
    footprints) as read from ``output``.
    """
    from ..sources.io import read_conformed, read_outputs, write_outputs
    from ..sources.io import path_exists
    from ..sources.manifest import manifest_path
    path = f"{input_dir}/conform"
    conf = read_conformed(spark, path, keep_bbox=True)
    fips = None if fips is None else list(fips)
    if fips is not None:
        conf = conf.filter(F.col("fips").isin(fips))
    with TableScope():
        if not path_exists(spark, manifest_path(path)):
            conf = checkpoint(conf)  # the boxes aren't stored: computed once
        write_outputs(*conflate(conf, **kw), output, fips)
    return read_outputs(spark, output, fips)
