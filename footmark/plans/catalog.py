"""Registered queries: one per operator of the inventory, over the driver's tables.

Each function takes ``(spark, sf_dir)``, derives the provider layers from the
input tables (:mod:`footmark.sources.fixtures`) and returns a DataFrame with
plain, explicitly named and typed columns (geometry is reported through its
coordinates, reference lists as sorted ``provider:key`` text), so the same
result can be computed by an independent SQL engine.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import (st_area, st_bbox, st_centroid, st_centroid_x, st_centroid_xy,
                                  st_centroid_y, st_collect, st_distance, st_intersection,
                                  st_intersects, st_is_valid_wkb, st_point, st_points, st_polygons, st_transform_to_5070, with_bbox)
from ..functions.plus_codes import plus_code
from ..functions.projection import albers_inverse
from ..functions.text import normalize_address, normalize_str, parse_height, parse_levels
from ..operators.correspondence import (checkpoint, correspondence_pairs, anti_join, distance_metric,
                                        merge_footprints_and_addresses, spatial_correspondence)
from ..operators.counties import check_codes, county_index, county_of, lookup_county, mask_by_county, states
from ..operators.spatial_join import candidate_pairs, dwithin_join, intersects_join, suffixed
from ..providers import get_provider
from ..providers.conform import address_units, to_conform
from ..session import configure, ensure_checkpoint_dir, prefer_partitions, prefer_small_tasks
from ..sources import fixtures as fx
from ..sources.counties import read_counties
from ..sources.io import existing_partitions, provider_rank, read_conformed, read_raw, write_raw_layer
from ..sources.manifest import read_manifest, verify_partitions
from .conflate import (conflate, conflate_addresses, conflate_footprints, conflate_job, grid_levels,
                       provider_counts)
from .conform import conform_all, conform_job


def foreign_text(c: Column) -> Column:
    """Reference list as sorted 'provider:key' text joined by ','."""
    return F.array_join(F.array_sort(F.transform(
        c, lambda r: F.concat(r["provider"], F.lit(":"), F.coalesce(r["key"], F.lit(""))))), ",")


def _boxes(spark: SparkSession, sf: str) -> DataFrame:
    """osm, microsoft and usa_structures raw boxes with (provider, key, geometry)."""
    parts = [fx.raw_openstreetmap(spark, sf).select(F.lit("openstreetmap").alias("provider"),
                                                    F.col("fixture_key").alias("key"), "geometry"),
             fx.raw_microsoft(spark, sf).select(F.lit("microsoft").alias("provider"),
                                                F.col("fixture_key").alias("key"), "geometry"),
             fx.raw_usa_structures(spark, sf).select(F.lit("usa_structures").alias("provider"),
                                                     F.col("fixture_key").alias("key"), "geometry")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _keyed(df: DataFrame) -> DataFrame:
    return df.select(F.col("fixture_key").alias("k"), "geometry")


def _start(spark: SparkSession, sf: str) -> None:
    prefer_partitions(prefer_small_tasks(configure(spark)), fx.tasks_of(spark, sf))


# --------------------------------------------------------------------------- joins


def j1_intersects_join(spark, sf):
    _start(spark, sf)
    p = intersects_join(_keyed(fx.raw_openstreetmap(spark, sf)), _keyed(fx.raw_microsoft(spark, sf)))
    return p.select(F.col("k_left").alias("left_key"), F.col("k_right").alias("right_key"))


def j2_dwithin_join(spark, sf):
    _start(spark, sf)
    p = dwithin_join(_keyed(fx.raw_nad(spark, sf)), _keyed(fx.raw_openstreetmap(spark, sf)), 10.0)
    return p.select(F.col("k_left").alias("left_key"), F.col("k_right").alias("right_key"),
                    F.round("metric", 6).alias("distance"))


def j4_overlap_correspondence(spark, sf):
    _start(spark, sf)
    from ..operators.correspondence import overlap_metric
    p = intersects_join(_keyed(fx.raw_openstreetmap(spark, sf)), _keyed(fx.raw_microsoft(spark, sf)))
    p = overlap_metric(p)
    return p.select(F.col("k_left").alias("left_key"), F.col("k_right").alias("right_key"),
                    F.col("area_intersection").cast("double").alias("area_intersection"),
                    F.col("area_relative").cast("double").alias("area_relative"),
                    F.round("metric", 9).alias("metric"), F.col("corresponds"))


def j5_distance_correspondence(spark, sf):
    """Address points against the other address layer and the footprints: pairs up to 40 m, match below 10 m."""
    _start(spark, sf)
    left = suffixed(with_bbox(_keyed(fx.raw_nad(spark, sf))), "_left")
    rights = [with_bbox(_keyed(fx.raw_openaddresses(spark, sf))).withColumn("p", F.lit("openaddresses")),
              with_bbox(_keyed(fx.raw_openstreetmap(spark, sf))).withColumn("p", F.lit("openstreetmap"))]
    p = candidate_pairs(left, suffixed(rights[0].unionByName(rights[1]), "_right"), grow=40.0)
    p = distance_metric(p).filter(F.col("metric") < 40.0)
    return p.select(F.col("k_left").alias("left_key"), F.col("p_right").alias("right_provider"), F.col("k_right").alias("right_key"),
                    F.round("metric", 6).alias("metric"), "corresponds")


# --------------------------------------------------------------------------- geometry functions


def g3_area(spark, sf):
    _start(spark, sf)
    return _boxes(spark, sf).select("provider", "key", st_area("geometry").alias("area"))


def g12_bbox(spark, sf):
    _start(spark, sf)
    b = st_bbox("geometry")
    return _boxes(spark, sf).select("provider", "key", b["xmin"].alias("xmin"), b["ymin"].alias("ymin"),
                                    b["xmax"].alias("xmax"), b["ymax"].alias("ymax"))


def g5_g6_centroid_xy(spark, sf):
    _start(spark, sf)
    return _boxes(spark, sf).select("provider", "key", st_centroid_x("geometry").alias("x"),
                                    st_centroid_y("geometry").alias("y"))


def g8_centroid(spark, sf):
    _start(spark, sf)
    c = st_centroid_xy(st_centroid("geometry"))
    return _boxes(spark, sf).select("provider", "key", c["x"].alias("x"), c["y"].alias("y"))


def g4_intersection(spark, sf):
    _start(spark, sf)
    p = intersects_join(_keyed(fx.raw_openstreetmap(spark, sf)), _keyed(fx.raw_microsoft(spark, sf)))
    p = p.withColumn("__i", st_intersection("geometry_left", "geometry_right"))
    c = st_centroid_xy("__i")
    return p.select(F.col("k_left").alias("left_key"), F.col("k_right").alias("right_key"),
                    st_area("__i").alias("area"), c["x"].alias("x"), c["y"].alias("y"))


def _same_slot(spark, sf, left: DataFrame, right: DataFrame) -> DataFrame:
    return _keyed(left).alias("l").join(_keyed(right).alias("r"), F.col("l.k") == F.col("r.k"))


def g7_distance(spark, sf):
    _start(spark, sf)
    j = _same_slot(spark, sf, fx.raw_nad(spark, sf), fx.raw_openstreetmap(spark, sf))
    return j.select(F.col("l.k").alias("key"), F.round(st_distance("l.geometry", "r.geometry"), 6).alias("distance"))


def g13_intersects(spark, sf):
    _start(spark, sf)
    j = _same_slot(spark, sf, fx.raw_openstreetmap(spark, sf), fx.raw_microsoft(spark, sf))
    return j.select(F.col("l.k").alias("key"), st_intersects("l.geometry", "r.geometry").alias("intersects"))


# --------------------------------------------------------------------------- slanted shapes


def _triangles(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Both footprint layers as triangles, whose slanted sides cross in many pairs."""
    k = F.col("fixture_key")
    return _keyed(fx.halved(fx.raw_openstreetmap(spark, sf), k % 2 == 1)), _keyed(fx.halved(fx.raw_microsoft(spark, sf), k % 3 == 1))


def g3_slanted_area(spark, sf):
    _start(spark, sf)
    parts = [t.select(F.lit(p).alias("provider"), "k", "geometry", st_centroid_xy("geometry").alias("c"))
             for p, t in zip(("openstreetmap", "microsoft"), _triangles(spark, sf))]
    return parts[0].unionByName(parts[1]).select("provider", F.col("k").alias("key"), st_area("geometry").alias("area"),
                                                 F.round("c.x", 6).alias("x"), F.round("c.y", 6).alias("y"))


def g4_slanted_intersection(spark, sf):
    """Area and number of polygons of each common part (shapes that only touch have none)."""
    _start(spark, sf)
    p = intersects_join(*_triangles(spark, sf)).withColumn("i", st_intersection("geometry_left", "geometry_right"))
    p = p.select(F.col("k_left").alias("left_key"), F.col("k_right").alias("right_key"), st_area("i").alias("a"),
                 F.when(st_is_valid_wkb("i"), F.col("i")).alias("i"))
    return p.select("left_key", "right_key", F.round("a", 6).alias("area"),
                    F.coalesce(F.size(st_polygons("i")), F.lit(0)).cast("bigint").alias("n_polygons"))


def g7_slanted_distance(spark, sf):
    _start(spark, sf)
    j = _keyed(fx.raw_nad(spark, sf)).alias("l").join(_triangles(spark, sf)[0].alias("r"), F.col("l.k") == F.col("r.k"))
    return j.select(F.col("l.k").alias("key"), F.round(st_distance("l.geometry", "r.geometry"), 6).alias("distance"))


def g13_slanted_intersects(spark, sf):
    _start(spark, sf)
    left, right = _triangles(spark, sf)
    j = left.alias("l").join(right.alias("r"), F.col("l.k") == F.col("r.k"))
    return j.select(F.col("l.k").alias("key"), st_intersects("l.geometry", "r.geometry").alias("intersects"))


def j4_slanted_overlap(spark, sf):
    """J1 and J4 on triangles: every pair that meets, with its share of the smaller area."""
    _start(spark, sf)
    from ..operators.correspondence import overlap_metric
    p = overlap_metric(intersects_join(*_triangles(spark, sf)))
    return p.select(F.col("k_left").alias("left_key"), F.col("k_right").alias("right_key"),
                    F.round("area_intersection", 6).alias("area_intersection"), F.col("area_relative").cast("double").alias("area_relative"),
                    F.round("metric", 9).alias("metric"), F.col("corresponds"))


# --------------------------------------------------------------------------- generators and codes


def g10_explode_multipoint(spark, sf):
    _start(spark, sf)
    o = _keyed(fx.raw_openstreetmap(spark, sf))
    e = o.select("k", F.explode_outer(st_points("geometry")).alias("pt"))
    c = st_centroid_xy("pt")
    return e.select(F.col("k").alias("key"), c["x"].alias("x"), c["y"].alias("y"))


def g11_explode_multipolygon(spark, sf):
    _start(spark, sf)
    from ..functions.geometry import st_box
    o = _keyed(fx.raw_openstreetmap(spark, sf))
    b = st_bbox("geometry")
    o = o.select("k", "geometry", b["xmin"].alias("x0"), b["ymin"].alias("y0"),
                 b["xmax"].alias("x1"), b["ymax"].alias("y1"))
    second = st_box(F.col("x0") + 20, F.col("y0"), F.col("x1") + 20, F.col("y0") + 5)
    mp = o.select("k", st_collect(F.array(F.col("geometry"), second)).alias("mp"))
    e = mp.select("k", F.explode_outer(st_polygons("mp")).alias("part"))
    c = st_centroid_xy("part")
    return e.select(F.col("k").alias("key"), st_area("part").alias("area"), c["x"].alias("x"), c["y"].alias("y"))


def g9_pluscode(spark, sf):
    _start(spark, sf)
    o = _keyed(fx.raw_openstreetmap(spark, sf)).withColumn("c", st_centroid_xy("geometry"))
    lon, lat = albers_inverse(F.col("c.x"), F.col("c.y"))
    return o.select(F.col("k").alias("key"), plus_code(lat, lon).alias("code"))


def p3_reproject(spark, sf):
    _start(spark, sf)
    n = _keyed(fx.raw_nad(spark, sf)).withColumn("c", st_centroid_xy("geometry"))
    lon, lat = albers_inverse(F.col("c.x"), F.col("c.y"))
    return n.select(F.col("k").alias("key"), F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


# --------------------------------------------------------------------------- conform


def _conform_out(df: DataFrame, key: str | None = None) -> DataFrame:
    df = to_conform(df)
    c = st_centroid_xy("geometry")
    return df.select(F.col("id").cast("string").alias("id"), "classification", "address",
                     F.col("height").cast("double").alias("height"), F.col("levels").cast("int").alias("levels"),
                     c["x"].alias("x"), c["y"].alias("y"))


def c1_conform_microsoft(spark, sf):
    _start(spark, sf)
    return _conform_out(fx.raw_microsoft(spark, sf).transform(get_provider("microsoft").conform))


def c2_conform_nad(spark, sf):
    _start(spark, sf)
    return _conform_out(fx.raw_nad(spark, sf).transform(get_provider("nad").conform))


def c3_conform_openaddresses(spark, sf):
    _start(spark, sf)
    return _conform_out(fx.raw_openaddresses(spark, sf).drop("fixture_key").transform(get_provider("openaddresses").conform))


def c4_conform_openstreetmap(spark, sf):
    _start(spark, sf)
    return _conform_out(fx.raw_openstreetmap(spark, sf).transform(get_provider("openstreetmap").conform))


def c5_conform_usa_structures(spark, sf):
    _start(spark, sf)
    return _conform_out(fx.raw_usa_structures(spark, sf).transform(get_provider("usa_structures").conform))


def c4h_height_parser(spark, sf):
    _start(spark, sf)
    o = fx.raw_openstreetmap(spark, sf)
    return o.select(F.col("fixture_key").alias("key"), F.col("height").alias("height_text"),
                    parse_height(F.col("height")).alias("height"))


def c4l_levels_parser(spark, sf):
    _start(spark, sf)
    o = fx.raw_openstreetmap(spark, sf)
    cls = F.nullif(F.coalesce("building", "amenity", "leisure"), F.lit("yes"))
    return o.select(F.col("fixture_key").alias("key"), F.col("building_levels").alias("levels_text"),
                    cls.alias("classification"),
                    parse_levels(F.col("building_levels"), cls).alias("levels"))


def t1_normalize_str(spark, sf):
    _start(spark, sf)
    d = fx.read_table(spark, sf, "documents").select("doc_id", "text")
    n = normalize_str(F.col("text"))
    return d.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.sha2(n, 256).alias("text_sha256"),
                    F.length(n).cast("bigint").alias("n_chars"))


def t6_normalize_address(spark, sf):
    _start(spark, sf)
    n = fx.raw_nad(spark, sf)
    raw = F.concat_ws(" ", "AddNo_Full", "StNam_Full", "SubAddress")
    return n.select(F.col("fixture_key").alias("key"), raw.alias("raw_address"),
                    normalize_address(raw).alias("address"))


def t6_address_grammar(spark, sf):
    """Addresses whose words mean something else in another place: lettered streets, saints, units, directions."""
    _start(spark, sf)
    n = fx.raw_nad(spark, sf).select(F.col("fixture_key").alias("key"))
    raw = F.concat_ws(" ", (F.col("key") % 97 + 1).cast("string"), fx.pick(fx.ADDRESS_FORMS, F.col("key")))
    return n.select("key", raw.alias("raw_address"), normalize_address(raw).alias("address"))


def w7_w8_address_units(spark, sf):
    _start(spark, sf)
    o = fx.raw_openaddresses(spark, sf)
    c = st_centroid_xy("geometry")
    return address_units(o.select("*", c["x"].alias("x"), c["y"].alias("y")), ["x", "y"], "fixture_key", ["number", "street", "unit"])


# --------------------------------------------------------------------------- counties


def _raw_all(spark, sf) -> dict[str, DataFrame]:
    return {p: fx.raw_layer(spark, sf, p) for p in fx.RAW_LAYERS}


def _raw_clean(spark, sf) -> dict[str, DataFrame]:
    """The raw layers without the key that only the queries on raw rows use."""
    return {p: df.drop("fixture_key") for p, df in _raw_all(spark, sf).items()}


def s2_county_mask(spark, sf):
    _start(spark, sf)
    counties = county_index(fx.counties(spark, sf))
    parts = []
    for p, df in _raw_all(spark, sf).items():
        m = mask_by_county(df.select(F.col("fixture_key").alias("key"), "geometry"), counties)
        parts.append(m.select(F.lit(p).alias("provider"), "key", "fips"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def j9_county_lookup(spark, sf):
    _start(spark, sf)
    o = fx.raw_openstreetmap(spark, sf).select(F.col("fixture_key").alias("key"), "geometry")
    n = fx.raw_nad(spark, sf).select(F.col("fixture_key").alias("key"), "geometry")
    idx = county_index(fx.counties(spark, sf))
    a = county_of(o, idx, key="key").select(F.lit("openstreetmap").alias("provider"), "key", "fips")
    b = county_of(n, idx, key="key").select(F.lit("nad").alias("provider"), "key", "fips")
    return a.unionByName(b)


def j10_county_names(spark, sf):
    _start(spark, sf)
    o = fx.raw_openstreetmap(spark, sf).select(F.col("fixture_key").alias("key"), "geometry")
    c = fx.counties(spark, sf)
    located = county_of(o, c, key="key").select("key", "fips")
    named = lookup_county(located, c)
    return named.select("key", "fips", "county_name", "state_name", "state_abbr")


def _with_outliers(spark, sf) -> dict[str, DataFrame]:
    layers = {p: df.select(F.col("fixture_key").alias("key"), "geometry") for p, df in _raw_all(spark, sf).items()}
    return layers | {"outlier": fx.outliers(spark, sf).select(F.col("fixture_key").alias("key"), "geometry")}


def _stack(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def s2_slanted_counties(spark, sf):
    """The mask with triangular counties, and with features of 1,000 km among the others."""
    _start(spark, sf)
    idx = county_index(fx.slanted_counties(spark, sf))
    return _stack([mask_by_county(df, idx).select(F.lit(p).alias("provider"), "key", "fips") for p, df in _with_outliers(spark, sf).items()])


def j9_slanted_counties(spark, sf):
    _start(spark, sf)
    idx = county_index(fx.slanted_counties(spark, sf))
    return _stack([county_of(df, idx, key="key").select(F.lit(p).alias("provider"), "key", "fips")
                   for p, df in _with_outliers(spark, sf).items()])


def s10_read_counties(spark, sf):
    """The county layer written as gzip GeoJSON lines in degrees and read back to metres."""
    _start(spark, sf)
    path = _scratch(spark, "counties")
    c = fx.counties(spark, sf).select("*", F.posexplode(st_points("geometry")).alias("at", "p"))
    xy = st_centroid_xy("p")
    lon, lat = albers_inverse(F.col("x"), F.col("y"))
    c = c.select("fips", "county_name", "state_name", "state_abbr", "at", xy["x"].alias("x"), xy["y"].alias("y")) \
        .withColumn("c", F.format_string("[%.12f,%.12f]", lon, lat)) \
        .groupBy("fips", "county_name", "state_name", "state_abbr").agg(F.array_sort(F.collect_list(F.struct("at", "c"))).alias("ring"))
    props = F.to_json(F.struct("fips", F.col("county_name").alias("name"), F.col("state_name").alias("state"), F.col("state_abbr").alias("abbr")))
    line = F.concat(F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":{"type":"Polygon","coordinates":[['),
                    F.array_join(F.transform("ring", lambda r: r["c"]), ","), F.lit("]]}}"))
    c.select(line.alias("value")).write.option("compression", "gzip").text(path)
    read = read_counties(spark, path)
    check_codes(read.select(F.substring("fips", 1, 2).alias("fips")).union(read.select("fips")), read)  # the strict form passes
    b = st_bbox("geometry")
    return read.select("fips", "county_name", "state_name", "state_abbr", *[F.round(b[k], 2).alias(k) for k in ("xmin", "ymin", "xmax", "ymax")],
                       F.lit("ok").alias("code"))


def j10_codes(spark, sf):
    """State codes of two characters, county codes of five, and unknown ones, counted and named."""
    _start(spark, sf)
    n = fx.read_table(spark, sf, "customer").select(F.col("c_nationkey").alias("k"))
    state = F.lpad((F.col("k") % 7 + 1).cast("string"), 2, "0")
    codes = n.select(F.explode(F.array(state, F.concat(state, F.lpad((F.col("k") * 4 + 1).cast("string"), 3, "0")))).alias("code")) \
        .groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    return lookup_county(codes, fx.counties(spark, sf), "code").select("code", "n", "county_name", "state_name")


def a4_state_bounds(spark, sf):
    _start(spark, sf)
    c = fx.counties(spark, sf)
    st = states(c)
    # footprints per state (masked by county), so the report follows the data
    o = fx.raw_openstreetmap(spark, sf).select(F.col("fixture_key").alias("key"), "geometry")
    per_state = mask_by_county(o, county_index(c)).groupBy(F.substring("fips", 1, 2).alias("state_fips")) \
        .agg(F.countDistinct("key").cast("bigint").alias("n_footprints"))
    return st.join(per_state, "state_fips", "left").select(
        "state_fips", "state_name", "state_abbr", "xmin", "ymin", "xmax", "ymax",
        F.col("area").cast("double").alias("area"), F.col("n_counties").cast("bigint").alias("n_counties"),
        st_area("geometry").alias("union_area"),
        F.coalesce("n_footprints", F.lit(0).cast("bigint")).alias("n_footprints"))


# --------------------------------------------------------------------------- pipelines


def conformed(spark, sf) -> DataFrame:
    """All raw layers masked by county and conformed (C7's DataFrame)."""
    return conform_all(_raw_clean(spark, sf), fx.counties(spark, sf))


# Checkpointed intermediates shared by the queries of one session (keyed by
# application and data directory): the conformed layers and one conflation.
_MEMO: dict = {}


def clear_cache() -> None:
    _MEMO.clear()


def _memo(spark, sf, name, build):
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _MEMO:
        _MEMO[key] = build()
    return _MEMO[key]


def conformed_checkpoint(spark, sf) -> DataFrame:
    return _memo(spark, sf, "conformed", lambda: checkpoint(conformed(spark, sf)))


def conflated(spark, sf):
    """(entities, crossref, footprints) of one conflation, shared by c8 / s8 / s9."""
    # lineage of each starts at checkpoints taken inside ``conflate``
    return _memo(spark, sf, "conflated", lambda: conflate(conformed_checkpoint(spark, sf)))


def _rows_out(df: DataFrame) -> DataFrame:
    c = st_centroid_xy("geometry")
    return df.select("fips", "provider", F.col("id").cast("string").alias("id"), "classification", "address",
                     F.col("height").cast("double").alias("height"), F.col("levels").cast("int").alias("levels"),
                     c["x"].alias("x"), c["y"].alias("y"))


def c7_conform_pipeline(spark, sf):
    _start(spark, sf)
    return _rows_out(conformed_checkpoint(spark, sf))


def a1_provider_counts(spark, sf):
    _start(spark, sf)
    return provider_counts(conformed_checkpoint(spark, sf)).select(
        "fips", "provider", F.col("n").cast("bigint").alias("n"))


def _layer(conf: DataFrame, p: str) -> DataFrame:
    return conf.filter(F.col("provider") == p)


def j6_anti_join(spark, sf):
    _start(spark, sf)
    conf = conformed_checkpoint(spark, sf)
    osm, ms = _layer(conf, "openstreetmap"), _layer(conf, "microsoft")
    pairs = correspondence_pairs(osm, ms).select(F.col("fips_left").alias("fips"),
                                                 F.col("provider_left").alias("provider"),
                                                 F.col("id_left").alias("id"))
    out = anti_join(osm, pairs, ["provider", "id"], ["provider", "id"], ["fips"])
    return out.select("fips", "provider", "id")


def _corr_out(df: DataFrame) -> DataFrame:
    c = st_centroid_xy("geometry")
    return df.select("fips", "provider", F.col("id").cast("string").alias("id"), "classification", "address",
                     F.col("height").cast("double").alias("height"), F.col("levels").cast("int").alias("levels"),
                     foreign_text(F.col("foreign")).alias("foreign_keys"), c["x"].alias("x"), c["y"].alias("y"))


def j7_spatial_correspondence(spark, sf):
    _start(spark, sf)
    conf = conformed_checkpoint(spark, sf)
    return _corr_out(spatial_correspondence(_layer(conf, "openstreetmap"), _layer(conf, "microsoft")))


def j7_address_correspondence(spark, sf):
    _start(spark, sf)
    conf = conformed_checkpoint(spark, sf)
    return _corr_out(spatial_correspondence(_layer(conf, "nad"), _layer(conf, "openaddresses"),
                                            use_distance=True))


def j7_footprint_fold(spark, sf):
    _start(spark, sf)
    conf = conformed_checkpoint(spark, sf)
    return _corr_out(conflate_footprints(conf, occupied=grid_levels(conf)))


def _entities_out(df: DataFrame) -> DataFrame:
    return df.select("fips", F.col("id").alias("id"), "classification", "address",
                     F.col("height").cast("double").alias("height"), F.col("levels").cast("int").alias("levels"),
                     "x", "y", foreign_text(F.col("foreign")).alias("foreign_keys"))


def j8_merge(spark, sf):
    _start(spark, sf)
    from .conflate import ADDRESS_ORDER, FOOTPRINT_ORDER, _levels
    conf = conformed_checkpoint(spark, sf)
    occ = grid_levels(conf)
    fp = checkpoint(conflate_footprints(conf, occupied=occ))
    ad = checkpoint(conflate_addresses(conf, occupied=occ))
    lv = _levels(occ, ADDRESS_ORDER, FOOTPRINT_ORDER, 10.0)
    return _entities_out(merge_footprints_and_addresses(fp, ad, levels=lv))


def c8_conflate_entities(spark, sf):
    _start(spark, sf)
    ent, _, _ = conflated(spark, sf)
    return ent.select("fips", "id", "classification", "address", F.col("height").cast("double").alias("height"),
                      F.col("levels").cast("int").alias("levels"), "x", "y")


def s8_crossref(spark, sf):
    _start(spark, sf)
    _, xref, _ = conflated(spark, sf)
    return xref.select("fips", "entity_id", "provider", "provider_id")


def s9_footprints(spark, sf):
    _start(spark, sf)
    _, _, fp = conflated(spark, sf)
    c = st_centroid_xy("geometry")
    return fp.select("fips", "provider", F.col("id").cast("string").alias("id"), c["x"].alias("x"), c["y"].alias("y"))


# --------------------------------------------------------------------------- readers and writers


def _scratch(spark, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/footmark-tables/{name}-{uuid.uuid4().hex}"


def _written_conform(spark, sf) -> str:
    """Output folder of two conform jobs: one state first, then all counties (which skips what is there)."""
    def build():
        out, cs = _scratch(spark, "conform"), fx.counties(spark, sf)
        raw = _raw_clean(spark, sf)
        some = [r[0] for r in cs.filter(F.substring("fips", 1, 2) == "01").select("fips").collect()]
        conform_job(spark, raw.__getitem__, list(raw), cs, out, fips=some)
        conform_job(spark, raw.__getitem__, list(raw), cs, out)
        return out
    return _memo(spark, sf, "written_conform", build)


def _written_conflate(spark, sf) -> str:
    """Output folder of a conflate job of all counties and a second run of one of them."""
    def build():
        out = _written_conform(spark, sf)
        conflate_job(spark, out, out)
        one = existing_partitions(spark, f"{out}/conform").agg(F.min("fips")).first()[0]
        if one is not None:
            conflate_job(spark, out, out, fips=[one])
        return out
    return _memo(spark, sf, "written_conflate", build)


def s1_read_geojson(spark, sf):
    """Polygons (even keys) and multipolygons in one file, written as GeoJSON lines and read back."""
    _start(spark, sf)
    path = _scratch(spark, "geojson")
    b = st_bbox("geometry")
    o = fx.raw_openstreetmap(spark, sf).select("fixture_key", "height", b.alias("b"))
    x0, y0, x1, y1 = (F.col(f"b.{c}").cast("string") for c in ("xmin", "ymin", "xmax", "ymax"))
    ring = F.concat(F.lit("[["), F.concat_ws("],[", *[F.concat_ws(",", x, y) for x, y in (
        (x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]), F.lit("]]"))
    shape = F.when(F.col("fixture_key") % 2 == 0, F.concat(F.lit('{"type":"Polygon","coordinates":['), ring, F.lit("]}"))) \
        .otherwise(F.concat(F.lit('{"type":"MultiPolygon","coordinates":[['), ring, F.lit("]]}")))
    props = F.to_json(F.struct(F.col("fixture_key").alias("key"), F.col("height").alias("height_text")))
    o.select(F.concat(F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'), shape, F.lit("}"))
             .alias("value")).write.text(path)
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("height_text", T.StringType())])
    c = st_centroid_xy("geometry")
    return read_raw(spark, path, "geojson", schema).select(
        "key", "height_text", st_area("geometry").alias("area"), c["x"].alias("x"), c["y"].alias("y"))


def p3_forward(spark, sf):
    """Degrees back to metres, for points that the inverse projection made."""
    _start(spark, sf)
    n = _keyed(fx.raw_nad(spark, sf)).withColumn("c", st_centroid_xy("geometry"))
    pts = n.select("k", st_point(*albers_inverse(F.col("c.x"), F.col("c.y"))).alias("geometry"))
    c = st_centroid_xy(st_transform_to_5070("geometry"))
    # + 0.0: no negative zero
    return pts.select(F.col("k").alias("key"), (F.round(c["x"], 3) + 0.0).alias("x"), (F.round(c["y"], 3) + 0.0).alias("y"))


def s4_write_conformed(spark, sf):
    _start(spark, sf)
    return _rows_out(read_conformed(spark, f"{_written_conform(spark, sf)}/conform"))


def s3_empty_input(spark, sf):
    """A conform job with an empty layer beside a full one: the partitions on disk have rows, and only the full one's."""
    _start(spark, sf)
    raw = _raw_clean(spark, sf)
    layers = {"openstreetmap": raw["openstreetmap"], "nad": raw["nad"].limit(0), "microsoft": raw["microsoft"].filter(F.lit(False))}
    out = _scratch(spark, "conform")
    conform_job(spark, layers.__getitem__, list(layers), fx.counties(spark, sf), out)
    found = existing_partitions(spark, f"{out}/conform").withColumnsRenamed({"fips": "f", "provider": "p"})
    rows = provider_counts(read_conformed(spark, f"{out}/conform"))
    return found.join(rows, (F.col("f") == F.col("fips")) & (F.col("p") == F.col("provider")), "left") \
        .select(F.col("f").alias("fips"), F.col("p").alias("provider"), F.col("n").cast("bigint").alias("n"))


def s5_skip_existing(spark, sf):
    """Rows per partition after the second run: a partition written twice would count double."""
    _start(spark, sf)
    return provider_counts(read_conformed(spark, f"{_written_conform(spark, sf)}/conform")).select(
        "fips", "provider", F.col("n").cast("bigint").alias("n"))


def s5_partition_manifest(spark, sf):
    """The manifest after two conform jobs, and whether the rows on disk still agree with it."""
    _start(spark, sf)
    path = f"{_written_conform(spark, sf)}/conform"
    return read_manifest(spark, path).join(verify_partitions(spark, path), ["fips", "provider"], "full").select(
        "fips", "provider", F.col("n").cast("bigint").alias("n"), "xmin", "ymin", "xmax", "ymax", "state")


def s6_window_scan(spark, sf):
    """The written layers read by a window: the lower left quarter of their box."""
    _start(spark, sf)
    path = f"{_written_conform(spark, sf)}/conform"
    x0, y0, x1, y1 = read_manifest(spark, path).agg(F.min("xmin"), F.min("ymin"), F.max("xmax"), F.max("ymax")).first()
    window = [] if x0 is None else [(x0, y0, x0 + (x1 - x0) / 4, y0 + (y1 - y0) / 4)]
    return _rows_out(read_conformed(spark, path, within=window))


def s2_pruned_read(spark, sf):
    """Raw layers written along the curve; the conform job of one state reads the part around its counties."""
    _start(spark, sf)
    raw, out = _raw_clean(spark, sf), _scratch(spark, "pruned")
    for p, df in raw.items():
        write_raw_layer(df, f"{out}/raw/{p}")
    cs = fx.counties(spark, sf)
    some = [r[0] for r in cs.filter(F.substring("fips", 1, 2) == "01").select("fips").collect()]
    return _rows_out(conform_job(spark, lambda p: read_raw(spark, f"{out}/raw/{p}"), list(raw), cs, out, fips=some, covering="bbox"))


def s7_write_entities(spark, sf):
    _start(spark, sf)
    ent = spark.read.parquet(f"{_written_conflate(spark, sf)}/conflate/entities")
    return ent.select("fips", "id", "classification", "address", F.col("height").cast("double").alias("height"),
                      F.col("levels").cast("int").alias("levels"), "x", "y")


def o1_crossref_order(spark, sf):
    """Rows per county of the written references, and how many stand before their predecessor's key."""
    _start(spark, sf)
    x = spark.read.parquet(f"{_written_conflate(spark, sf)}/conflate/crossref")
    key = F.struct("entity_id", provider_rank().alias("r"))
    prev = F.lag(key).over(Window.partitionBy("file").orderBy("row"))  # a file's rows, as they stand in it
    x = x.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return x.withColumn("late", (prev > key).cast("bigint")).groupBy("fips").agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("late"), F.lit(0)).cast("bigint").alias("n_unsorted"))


QUERIES = {
    "j1_intersects_join": j1_intersects_join,
    "j2_dwithin_join": j2_dwithin_join,
    "j4_overlap_correspondence": j4_overlap_correspondence,
    "j5_distance_correspondence": j5_distance_correspondence,
    "g3_area": g3_area,
    "g12_bbox": g12_bbox,
    "g5_g6_centroid_xy": g5_g6_centroid_xy,
    "g8_centroid": g8_centroid,
    "g4_intersection": g4_intersection,
    "g7_distance": g7_distance,
    "g13_intersects": g13_intersects,
    "g10_explode_multipoint": g10_explode_multipoint,
    "g11_explode_multipolygon": g11_explode_multipolygon,
    "g9_pluscode": g9_pluscode,
    "g3_slanted_area": g3_slanted_area,
    "g4_slanted_intersection": g4_slanted_intersection,
    "g7_slanted_distance": g7_slanted_distance,
    "g13_slanted_intersects": g13_slanted_intersects,
    "j4_slanted_overlap": j4_slanted_overlap,
    "p3_reproject": p3_reproject,
    "c1_conform_microsoft": c1_conform_microsoft,
    "c2_conform_nad": c2_conform_nad,
    "c3_conform_openaddresses": c3_conform_openaddresses,
    "w7_w8_address_units": w7_w8_address_units,
    "c4_conform_openstreetmap": c4_conform_openstreetmap,
    "c5_conform_usa_structures": c5_conform_usa_structures,
    "c4h_height_parser": c4h_height_parser,
    "c4l_levels_parser": c4l_levels_parser,
    "t1_normalize_str": t1_normalize_str,
    "t6_normalize_address": t6_normalize_address,
    "t6_address_grammar": t6_address_grammar,
    "s2_county_mask": s2_county_mask,
    "s2_slanted_counties": s2_slanted_counties,
    "j9_county_lookup": j9_county_lookup,
    "j9_slanted_counties": j9_slanted_counties,
    "j10_county_names": j10_county_names,
    "j10_codes": j10_codes,
    "s10_read_counties": s10_read_counties,
    "a4_state_bounds": a4_state_bounds,
    "c7_conform_pipeline": c7_conform_pipeline,
    "a1_provider_counts": a1_provider_counts,
    "j6_anti_join": j6_anti_join,
    "j7_spatial_correspondence": j7_spatial_correspondence,
    "j7_address_correspondence": j7_address_correspondence,
    "j7_footprint_fold": j7_footprint_fold,
    "j8_merge": j8_merge,
    "c8_conflate_entities": c8_conflate_entities,
    "s8_crossref": s8_crossref,
    "s9_footprints": s9_footprints,
    "s1_read_geojson": s1_read_geojson,
    "p3_forward": p3_forward,
    "s4_write_conformed": s4_write_conformed,
    "s3_empty_input": s3_empty_input,
    "s5_skip_existing": s5_skip_existing,
    "s5_partition_manifest": s5_partition_manifest,
    "s6_window_scan": s6_window_scan,
    "s2_pruned_read": s2_pruned_read,
    "s7_write_entities": s7_write_entities,
    "o1_crossref_order": o1_crossref_order,
}
