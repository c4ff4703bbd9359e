"""Edge units for the column expressions (tiny inline frames)."""

import datetime as dt

from pyspark.sql import functions as F

from groundstop.functions import (
    blank_to_null,
    date_from_parts,
    flag_text,
    hash_sample,
    hash_threshold,
    hour_of_departure,
    hour_padded_ref,
    hour_text,
    iso_week,
    number_text,
    route_key,
)


def test_hours(spark):
    df = spark.createDataFrame([("5",), ("45",), ("930",), ("1530",), (None,)], "t string")
    rows = df.select(
        hour_of_departure("t").alias("h"), hour_padded_ref("t").alias("ref"), hour_text("t").alias("txt")
    ).collect()
    assert [r.h for r in rows] == [0, 0, 9, 15, None]
    # The pad-one-zero form is only right for 3 and 4 digits.
    assert [r.ref for r in rows] == [5, 4, 9, 15, None]
    assert [r.txt for r in rows] == ["00", "00", "09", "15", None]


def test_number_text_drops_decimals(spark):
    df = spark.createDataFrame([(1530.0,), (5.0,), (None,)], "t double")
    assert [r[0] for r in df.select(number_text("t")).collect()] == ["1530", "5", None]


def test_date_from_double_parts(spark):
    df = spark.createDataFrame([(2008.0, 1.0, 3.0), (2008.0, 12.0, 31.0)], "y double, m double, d double")
    got = [r[0] for r in df.select(date_from_parts("y", "m", "d")).collect()]
    assert got == [dt.date(2008, 1, 3), dt.date(2008, 12, 31)]


def test_iso_week(spark):
    df = spark.createDataFrame([(dt.date(2008, 12, 29),), (dt.date(2010, 1, 1),)], "d date")
    assert [r[0] for r in df.select(iso_week("d")).collect()] == [1, 53]


def test_route_key_is_direction_free(spark):
    df = spark.createDataFrame([("ATL", "BOS"), ("BOS", "ATL")], "o string, d string")
    assert {r[0] for r in df.select(route_key("o", "d")).collect()} == {"ATL<>BOS"}


def test_blank_to_null_one_character_only(spark):
    df = spark.createDataFrame([(" ",), ("  ",), ("x",), ("",)], "v string")
    assert [r[0] for r in df.select(blank_to_null("v")).collect()] == [None, "  ", "x", ""]


def test_flag_text(spark):
    df = spark.createDataFrame([(1.0,), (0.0,)], "f double")
    assert [r[0] for r in df.select(flag_text("f")).collect()] == ["1", "0"]


def test_hash_threshold_values():
    assert hash_threshold(0.03) == "07ae147b"
    assert hash_threshold(0.75) == "c0000000"
    assert hash_threshold(1.0) == "g"


def test_hash_sample_is_layout_independent(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    one = {r.k for r in df.coalesce(1).where(hash_sample("k", 0.1)).collect()}
    many = {r.k for r in df.repartition(8).where(hash_sample("k", 0.1)).collect()}
    assert one == many
    assert 350 < len(one) < 650
