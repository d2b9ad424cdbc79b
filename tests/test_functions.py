"""Micro fixtures for the null rules, labels and time helpers (FIXTURES: null_sums, not_in_null,
species_filter, depth_bins, half_round, code_pad, zone_gap, composites)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from pelagic.functions import labels as lb
from pelagic.functions import nulls as nl
from pelagic.functions import timeops as tm
from pelagic.operators import indices as ix


def test_null_sums(spark):
    df = spark.createDataFrame(
        [("all_null", None), ("all_null", None), ("one_null", 1.0), ("one_null", None),
         ("none", 1.0), ("none", 2.0), ("nan", float("nan")), ("nan", 1.0)], "g string, x double")
    df = nl.nan_to_null(df)
    r = {row.g: row for row in df.groupBy("g").agg(
        nl.sum0("x").alias("s0"), nl.mean_na("x").alias("m"),
        nl.strict_sum("x").alias("ss"), nl.strict_max("x").alias("sm")).collect()}
    assert r["all_null"].s0 == 0 and r["all_null"].m is None and r["all_null"].ss is None
    assert r["one_null"].s0 == 1.0 and r["one_null"].ss is None and r["one_null"].sm is None
    assert r["none"].ss == 3.0 and r["none"].sm == 2.0 and r["none"].m == 1.5
    assert r["nan"].s0 == 1.0 and r["nan"].ss is None  # NaN folded to null (N-4)


def test_not_in_keeps_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "t string")
    kept = sorted((r.t or "<null>") for r in df.where(nl.not_in("t", ["a"])).collect())
    assert kept == ["<null>", "b"]
    keys = spark.createDataFrame([("a",), (None,)], "t string")
    kept2 = sorted((r.t or "<null>") for r in nl.not_in_frame(df, "t", keys).collect())
    assert kept2 == ["<null>", "b"]
    assert [r.t for r in df.where(nl.not_matches("t", "a")).orderBy("t").collect()] == [None, "b"]


def test_species_filter(spark):
    rows = [("G", "spp."), ("G", None), ("G", "cf. x"), ("G", "a/b"), ("G", "x grp"), ("G", "acfb"), ("G", "x y")]
    df = spark.createDataFrame(rows, "genus string, species string")
    out = sorted(r.TaxonName for r in ix.species_filter(df, "genus", "species", ix.MATRIX_DROP_PATTERNS).collect())
    # "acfb" contains "cf" followed by a character, so the regex "cf." drops it too (N-10)
    assert out == ["G x"]
    wide = sorted(r.TaxonName for r in ix.species_filter(df, "genus", "species", ix.MATRIX_DROP_PATTERNS, include_genus_level=True).collect())
    assert wide == ["G spp.", "G x"]  # D-25 switch: genus-level rows kept, other drops unchanged


def test_depth_bins_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (20.0,), (20.1,), (100.0,), (100.1,), (None,)], "d double")
    got = [r.b for r in df.select(lb.depth_bin("d").alias("b")).collect()]
    assert got == [None, "0 - 20m", "0 - 20m", "20 - 40m", "80 - 100m", None, None]


def test_half_round_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "x double")
    assert [r.r for r in df.select(F.bround("x", 0).alias("r")).collect()] == [0.0, 2.0, 2.0, -0.0]


def test_code_pad_never_truncates(spark):
    df = spark.createDataFrame([("5",), ("100",), ("1000",), ("WC",)], "d string")
    got = [r.c for r in df.select(lb.sample_code("NRS", F.lit("T1"), "d").alias("c")).collect()]
    assert got == ["NRST1_005", "NRST1_100", "NRST1_1000", "NRST1_WC"]


def test_zone_gap_and_overlap(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 10, 4, 2, 30),), (dt.datetime(2020, 4, 5, 2, 30),),
                                (dt.datetime(2020, 7, 1, 12, 0),)], "t timestamp_ntz")
    got = [r.u for r in df.select(tm.local_to_utc("t", "Australia/Sydney").alias("u")).collect()]
    # spring gap rolls forward: 02:30 does not exist -> 03:30 AEDT = 16:30 UTC previous day
    assert got[0] == dt.datetime(2020, 10, 3, 16, 30)
    # repeated hour resolves to the later (standard time) instant: 02:30 AEST = 16:30 UTC
    assert got[1] == dt.datetime(2020, 4, 4, 16, 30)
    assert got[2] == dt.datetime(2020, 7, 1, 2, 0)


def test_composites(spark):
    days = [dt.date(2021, 1, 1), dt.date(2021, 1, 4), dt.date(2021, 1, 12), dt.date(2021, 12, 27),
            dt.date(2020, 12, 31), dt.date(2021, 3, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    c8 = tm.eight_day_composite("d")
    cm = tm.month_composite("d")
    rows = df.select(c8["comp_start_doy"].alias("s"), c8["comp_end_doy"].alias("e"),
                     cm["month_start_doy"].alias("ms"), cm["month_end_doy"].alias("me")).collect()
    assert (rows[0].s, rows[0].e) == (1, 8)        # day 1 -> round(1/8)=0 -> 8
    assert (rows[1].s, rows[1].e) == (1, 8)        # day 4: 0.5 rounds to even 0 -> 8
    assert (rows[2].s, rows[2].e) == (9, 16)       # day 12: 1.5 -> 2
    assert (rows[3].s, rows[3].e) == (353, 360)    # day 361 cap
    assert (rows[4].s, rows[4].e) == (353, 360)    # leap day 366 capped at 361
    assert (rows[5].ms, rows[5].me) == (60, 90)    # March in a common year


def test_harmonic_and_decimal_year(spark):
    df = spark.createDataFrame([(91.5, dt.datetime(2020, 7, 2, 0, 0))], "doy double, t timestamp_ntz")
    r = df.select(tm.harmonic("doy", F.lit(10.0), F.lit(1.0), F.lit(2.0), F.lit(0.5), F.lit(0.25)).alias("h"),
                  tm.decimal_year("t").alias("y")).first()
    t = 2 * math.pi * 91.5 / 366
    assert abs(r.h - (10 + math.cos(t) + 2 * math.sin(t) + 0.5 * math.cos(2 * t) + 0.25 * math.sin(2 * t))) < 1e-12
    assert abs(r.y - (2020 + 183 / 366)) < 1e-12
