"""Text functions: the parser tables of FIXTURES.md §5 and normalisation."""

import pytest
from pyspark.sql import functions as F

from footmark.functions.text import normalize_address, normalize_str, parse_height, parse_levels

HEIGHT = [("12", 12.0), (" 12.5 ", 12.5), ("0", None), ("0.0", None), ("3;9;x", 9.0), ("30 ft", 9.144),
          ("10 m", 10.0), ("10 meters", None), ("30'", 9.144), ("-4", None), ("10f", None), ("abc", None),
          (None, None)]
LEVELS = [("3", None, 3), ("0", None, None), ("Default", None, None), ("Bi-Level", None, 2),
          ("Split", None, 2), ("1,2", "school", None), ("1,2", "house", 2), ("2.5", None, 3), (".5", None, None),
          ("1 1/2", None, 2), ("1,2,3", None, 3), ("1;4;2", None, 4), ("2; 3", None, 3), ("1-3", None, 3),
          ("-1", None, 1), ("3+", None, 3), (">3", None, 3), ("PK2", None, 2), ("3.0", None, None),
          ("111", None, None), ("110", None, 110), (None, None, None)]


def test_height_table(spark):
    df = spark.createDataFrame([(h,) for h, _ in HEIGHT], "h string")
    got = [r[0] for r in df.select(parse_height(F.col("h"))).collect()]
    for (h, want), g in zip(HEIGHT, got):
        assert (g is None and want is None) or g == pytest.approx(want), h


def test_levels_table(spark):
    df = spark.createDataFrame([(lv, c) for lv, c, _ in LEVELS], "lv string, c string")
    got = [r[0] for r in df.select(parse_levels(F.col("lv"), F.col("c"))).collect()]
    assert got == [w for _, _, w in LEVELS]


def test_normalize_str(spark):
    df = spark.createDataFrame([(" \tMain St\n",), (" Ünïcode　",), (None,), ("",)], "s string")
    got = [r[0] for r in df.select(normalize_str(F.col("s"))).collect()]
    assert got == ["main st", "ünïcode", None, ""]


def test_normalize_address(spark):
    rows = [("123 Main St",), ("12 N Oak Dr Apt 4",), ("0",), ("  5  Elm   Ln. ",), (None,), ("",),
            ("7 Pine Ct, Ste 2",)]
    df = spark.createDataFrame(rows, "a string")
    got = [r[0] for r in df.select(normalize_address(F.col("a"))).collect()]
    assert got == ["123 main street", "12 north oak drive apartment 4", None, "5 elm lane", None, None,
                   "7 pine court suite 2"]


def test_address_grammar(spark):
    cases = {"12 St Marys Ave": "12 saint marys avenue", "5 E St": "5 e street", "5 E Main St.": "5 east main street", "7 Avenue E": "7 avenue e",
             "7 Main St N": "7 main street north", "3 Ave B, Apt 3": "3 avenue b apartment 3", "8 W St Unit W": "8 w street unit w",
             "Town Hall 5 Oak Dr Unit B": "town hall 5 oak drive unit b", "9 Hwy 101": "9 highway 101", "1 Ft Worth Blvd #12": "1 fort worth boulevard unit 12",
             "22 N 1st St": "22 north 1st street", "4 Mt Hope Rd SW Ste 5": "4 mount hope road southwest suite 5", "12": None, "0": None, "": None,
             "Apt 4": None, "12 5": None, " \t": None, None: None, "6 N Way": "6 n way", "Broadway": "broadway", "2 S North St": "2 south north street",
             "3 Plaza Way Bldg C Fl 2": "3 plaza way building c floor 2", "12-14 Elm ln": "12-14 elm lane"}
    df = spark.createDataFrame([(k,) for k in cases], "a string")
    assert {r["a"]: r["n"] for r in df.select("a", normalize_address("a").alias("n")).collect()} == cases
