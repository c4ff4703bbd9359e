"""Fixture facts measured independently in the survey (sf0.001)."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from groundstop import fixtures as fx
from groundstop.functions import hash_sample
from groundstop.sources import load_tables

Q = E.queries()


def test_row_counts(spark, sf_dir):
    t = load_tables(spark, sf_dir)
    f = fx.flights(t)
    assert f.count() == 6000
    assert f.select("row_key").distinct().count() == 6000
    assert fx.flights_raw_1(t).count() == 3487 and fx.flights_raw_2(t).count() == 2513
    assert fx.flights_raw_1(t).where("cancelled = 1").count() == 169
    assert fx.flights_raw_2(t).where("cancelled = 1").count() == 130


def test_routes_and_carriers(spark, sf_dir):
    assert Q["rate_by_carrier"](spark, sf_dir).count() == 25
    assert Q["rate_by_route"](spark, sf_dir).count() == 205 - 45
    f = fx.flights(load_tables(spark, sf_dir))
    assert f.select("origin", "dest").distinct().count() == 250


def test_brand_1_rate(spark, sf_dir):
    row = Q["rate_by_carrier"](spark, sf_dir).where(F.col("op_carrier") == "Brand#1").first()
    assert (row.count_total, row.count_delays, row.delay_percent) == (237, 8, 3.375527)


def test_hash_sample_size(spark, sf_dir):
    f = fx.flights(load_tables(spark, sf_dir))
    assert f.where((F.col("cancelled") == 0) & hash_sample("row_key", 0.03)).count() == 174


def test_confusion_and_blocks(spark, sf_dir):
    cm = {(r.label, r.prediction): r.n for r in Q["confusion_matrix"](spark, sf_dir).collect()}
    assert cm == {(0, 0): 2396, (0, 1): 2430, (1, 0): 107, (1, 1): 149}
    assert Q["accuracy_by_block"](spark, sf_dir).count() == 50


def test_early_departures(spark, sf_dir):
    hours = Q["hour_of_departure"](spark, sf_dir)
    assert hours.where(F.col("hour") == 0).count() == 245
    ref = Q["hour_padded_ref"](spark, sf_dir).join(hours, "row_key")
    assert ref.where(F.col("hour_ref") != F.col("hour")).count() == 237
