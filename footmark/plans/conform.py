"""Conform job (C7): raw layers of every provider, every county, in one plan.

raw layer (S1) -> county mask (S2, adds fips) -> provider conform (C1-C5) ->
strict cast (P1) -> partitioned zstd parquet (S4), skipping partitions that
already exist (S5). An empty input writes nothing (S3).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import st_transform_to_5070
from ..operators.counties import county_index, mask_by_county
from ..operators.spatial_join import ensure_bbox
from ..providers import get_provider
from ..providers.conform import to_conform
from ..operators.correspondence import TableScope
from ..schema import CONFORM
from ..sources.io import covered, existing_partitions, read_conformed, write_conformed
from ..sources.manifest import BOX


def _epsg(source_epsg, provider: str) -> int:
    """The code of one provider's raw layer: one for all, a mapping, or "declared" (the registry's)."""
    if source_epsg == "declared":
        return get_provider(provider).epsg
    return source_epsg.get(provider, 5070) if isinstance(source_epsg, dict) else source_epsg


def conform_layer(raw: DataFrame, provider: str, counties=None, source_epsg: int | str | dict = 5070,
                  covering: str | None = None) -> DataFrame:
    """One provider: mask by county (when counties are given), conform, cast; adds ``provider``.

    ``counties`` is a county DataFrame or a prepared ``CountyIndex``. Raw layers
    are taken to be in EPSG:5070 already (as the source pipeline assumes);
    ``source_epsg=4326`` projects the geometry on read (Q26); other codes raise.
    It may be a mapping by provider, or "declared" for what the registry says.

    ``covering``: the struct column with each geometry's box, if the layer has one
    (:func:`~footmark.sources.io.write_raw_layer`). The boxes of the counties are then pushed into the
    read of the layer; the column itself is not an attribute.
    """
    df = raw
    source_epsg = _epsg(source_epsg, provider)
    if covering is not None and covering in df.columns:
        if counties is not None and source_epsg == 5070:  # the boxes are in the layer's coordinates
            counties = county_index(counties)
            df = covered(df, counties.boxes, covering)
        df = df.drop(covering)
    if source_epsg == 4326:
        df = df.withColumn("geometry", st_transform_to_5070(F.col("geometry")))
    elif source_epsg != 5070:
        raise ValueError(f"unsupported source EPSG {source_epsg}")
    if counties is not None:
        df = mask_by_county(df, counties, keep_bbox=True)
    out = to_conform(df.transform(get_provider(provider).conform))
    # the box (from the county lookup, or computed here) is carried by every later join
    return ensure_bbox(out.withColumn("provider", F.lit(provider)))


def conform_all(raw_layers: dict[str, DataFrame], counties: DataFrame | None = None,
                fips: Iterable[str] | None = None, source_epsg: int | str | dict = 5070,
                covering: str | None = None) -> DataFrame:
    """All providers stacked: CONFORM columns + fips + provider + xmin/ymin/xmax/ymax.

    The county index is built once and shared by every provider's mask.
    """
    idx = None
    if counties is not None:
        cs = counties if fips is None else counties.filter(F.col("fips").isin(list(fips)))
        idx = county_index(cs)
    parts = [conform_layer(df, name, idx, source_epsg, covering) for name, df in raw_layers.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)   # U2
    return out


def conform_job(spark: SparkSession, read_raw: Callable[[str], DataFrame], providers: list[str],
                counties: DataFrame, output: str, fips: Iterable[str] | None = None,
                source_epsg: int | str | dict = 5070, covering: str | None = None) -> DataFrame:
    """Conform ``providers`` for the requested counties and write ``output/conform``.

    Partitions (fips, provider) that the manifest lists are left alone, and no work is done for them
    (S5): each provider is masked only by the counties that it still lacks. With ``covering`` only the
    part of a raw layer around these counties is read. Returns the rows written, as read back; the
    tables written on the way are removed.
    """
    path = f"{output}/conform"
    done = existing_partitions(spark, path)
    done = set() if done is None else {tuple(r) for r in done.collect()}  # a row a county and provider
    cs = counties if fips is None else counties.filter(F.col("fips").isin(list(fips)))
    codes = list(dict.fromkeys(r[0] for r in cs.select("fips").collect()))  # the county reference layer
    lacking: dict[tuple, list[str]] = {}
    for p in providers:
        todo = tuple(f for f in codes if (f, p) not in done)
        if todo:
            lacking.setdefault(todo, []).append(p)
    if not lacking:
        fields = CONFORM.fields + [T.StructField(c, T.StringType()) for c in ("fips", "provider")] + [T.StructField(c, T.DoubleType()) for c in BOX]
        return spark.createDataFrame([], T.StructType(fields))
    only = F.lit(False)
    for todo, names in lacking.items():
        only = only | (F.col("fips").isin(list(todo)) & F.col("provider").isin(names))
    with TableScope():
        parts = [conform_all({p: read_raw(p) for p in names}, cs, todo, source_epsg, covering) for todo, names in lacking.items()]
        df = parts[0]
        for part in parts[1:]:
            df = df.unionByName(part, allowMissingColumns=True)
        write_conformed(df, path, only)
    return read_conformed(spark, path, keep_bbox=True).filter(only)
