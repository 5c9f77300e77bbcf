"""Fixed schemas of the registry (conformed layer, references, output tables)."""

from __future__ import annotations

from pyspark.sql import types as T

# Provider kinds in declaration order; crossref output sorts by this order.
PROVIDERS = ["openstreetmap", "microsoft", "usa_structures", "openaddresses", "nad"]

CONFORM = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("classification", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("height", T.DoubleType()),
    T.StructField("levels", T.IntegerType()),
    T.StructField("geometry", T.BinaryType()),
])

REFERENCE = T.StructType([
    T.StructField("provider", T.StringType()),
    T.StructField("key", T.StringType()),
])
FOREIGN = T.ArrayType(REFERENCE)

ENTITIES = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("classification", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("height", T.DoubleType()),
    T.StructField("levels", T.IntegerType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
])

CROSSREF = T.StructType([
    T.StructField("entity_id", T.StringType()),
    T.StructField("provider", T.StringType()),
    T.StructField("provider_id", T.StringType()),
])

FOOTPRINTS = T.StructType([
    T.StructField("provider", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("geometry", T.BinaryType()),
])

COUNTIES = T.StructType([
    T.StructField("fips", T.StringType()),
    T.StructField("county_name", T.StringType()),
    T.StructField("state_name", T.StringType()),
    T.StructField("state_abbr", T.StringType()),
    T.StructField("geometry", T.BinaryType()),
])
