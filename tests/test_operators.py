"""Micro fixtures for the domain operators (FIXTURES: shannon, change_log, profile, casts,
grid_plane, grid_box, polygons, trend, community) and properties from SURVEY §5.2."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from pelagic.operators import asof, changelog, community, grid, indices, profile, regions, reshape


def test_shannon_properties(spark):
    rows = [("one", "a", 5.0), ("four", "a", 1.0), ("four", "b", 1.0), ("four", "c", 1.0), ("four", "d", 1.0),
            ("zero", "a", 0.0), ("zero", "b", 2.0), ("zero", "c", 2.0)]
    df = spark.createDataFrame(rows, "s string, t string, v double")
    r = {x.s: x for x in indices.diversity(df, "s", "t", "v").collect()}
    assert r["one"].shannon == 0.0 and math.copysign(1, r["one"].shannon) == 1 and r["one"].evenness is None
    assert abs(r["four"].shannon - math.log(4)) < 1e-12 and abs(r["four"].evenness - 1.0) < 1e-12
    assert abs(r["zero"].shannon - math.log(2)) < 1e-12  # a zero taxon contributes nothing
    assert r["zero"].n_species == 3


def test_class_share_missing_class_is_null(spark):
    df = spark.createDataFrame([("s1", "CC", 1.0), ("s1", "CO", 3.0), ("s2", "CO", 2.0)], "s string, c string, v double")
    r = {x.s: x.r for x in indices.class_share(df, "s", "c", "v", "CO", "CC", "r").collect()}
    assert r == {"s1": 0.75, "s2": None}


def _absence(spark, samples, obs, log, level="genus"):
    s = spark.createDataFrame(samples, "sample string, sample_date timestamp_ntz")
    o = spark.createDataFrame(obs, "sample string, taxon string, genus string, value double")
    lg = spark.createDataFrame(log, "taxon string, start_date timestamp_ntz, parent string")
    out = changelog.absence_matrix(s, o, lg, label="genus", level=level)
    return {(r.sample, r.genus): r.value for r in out.collect()}


def test_change_log_rules(spark):
    d = dt.datetime
    samples = [("before", d(2000, 1, 1)), ("on", d(2001, 1, 1)), ("after", d(2002, 1, 1)),
               ("obs_after", d(2003, 1, 1)), ("obs_before", d(1999, 1, 1))]
    obs = [("obs_after", "Newg x", "Newg", 7.0), ("obs_before", "Newg x", "Newg", 4.0),
           ("after", "Oldg y", "Oldg", 2.0)]
    log = [("Newg x", d(2001, 1, 1), "Oldg x")]
    m = _absence(spark, samples, obs, log)
    assert m == {("obs_after", "Newg"): 7.0, ("obs_before", "Newg"): -999.0,  # a record before the start is overwritten
                 ("after", "Oldg"): 2.0}                                        # unaffected genus untouched
    s = spark.createDataFrame(samples, "sample string, sample_date timestamp_ntz")
    o = spark.createDataFrame(obs, "sample string, taxon string, genus string, value double")
    lg = spark.createDataFrame(log, "taxon string, start_date timestamp_ntz, parent string")
    wide = {r.sample: (r.Newg, r.Oldg) for r in changelog.absence_wide(s, o, lg).collect()}
    assert wide == {"before": (-999.0, 0.0),   # not looked for yet
                    "on": (None, 0.0),         # same date, no record -> null
                    "after": (0.0, 2.0),       # true absence
                    "obs_after": (7.0, 0.0), "obs_before": (-999.0, 0.0)}
    plan = changelog.absence_matrix(s, o, lg)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Cartesian" not in plan


def test_change_log_observed_flag(spark):
    d = dt.datetime
    s = spark.createDataFrame([("before", d(2000, 1, 1)), ("on", d(2001, 1, 1)), ("obs_after", d(2003, 1, 1)),
                               ("obs_before", d(1999, 1, 1)), ("mixed", d(2002, 1, 1))],
                              "sample string, sample_date timestamp_ntz")
    o = spark.createDataFrame([("obs_after", "Newg x", "Newg", 7.0), ("obs_before", "Newg x", "Newg", 4.0),
                               ("mixed", "Newg x", "Newg", 3.0), ("mixed", "Newg z", "Newg", 5.0)],
                              "sample string, taxon string, genus string, value double")
    lg = spark.createDataFrame([("Newg x", d(2001, 1, 1), "Oldg x"), ("Newg z", d(2002, 6, 1), "Oldg z")],
                               "taxon string, start_date timestamp_ntz, parent string")
    out = changelog.absence_matrix(s, o, lg, label="genus", observed_flag=True)
    m = {(r.sample, r.genus): (r.value, r.observed_flag) for r in out.collect()}
    assert m == {("obs_after", "Newg"): (7.0, True),
                 ("obs_before", "Newg"): (-999.0, False),   # record before its start date
                 ("mixed", "Newg"): (3.0 - 999.0, False)}   # one start passed, one not: sentinel summed in
    plain = changelog.absence_matrix(s, o, lg, label="genus")
    assert plain.columns == ["sample", "genus", "value"]


def test_change_log_never_observed_taxon_has_no_column(spark):
    d = dt.datetime
    m = _absence(spark, [("s", d(2000, 1, 1))], [("s", "A b", "A", 1.0)], [("Z q", d(2005, 1, 1), "Y q")])
    assert m == {("s", "A"): 1.0}


def test_profile_ties_and_nulls(spark):
    rows = [  # cast, depth, temp, sal, chl, ref
        ("c1", 8.0, 20.0, 35.0, 1.0, 10.0), ("c1", 12.0, 19.8, 35.1, 3.0, 10.0),
        ("c1", 20.0, 19.6, 34.97, 3.0, 10.0), ("c1", 30.0, 18.0, 34.0, 2.0, 10.0),
        ("c2", 10.0, 20.0, 35.0, 1.0, 10.0),                       # nothing below the reference
        ("c3", 10.0, 20.0, 35.0, 1.0, 10.0), ("c3", 15.0, 19.6, 35.0, None, 10.0),
    ]
    df = spark.createDataFrame(rows, "cast string, depth double, temp double, salinity double, chl double, ref_depth double")
    r = {x.cast: x for x in profile.mixed_layer(df).collect()}
    # reference: 8 and 12 tie at distance 2 -> shallower (8 m, T 20.0); target 19.6 -> 20 m
    assert r["c1"].MLD_temp == 20.0 and r["c1"].MLD_sal == 20.0
    assert r["c1"].DCM == 12.0  # tied maxima -> shallowest
    assert r["c2"].MLD_temp is None and r["c2"].DCM is None
    assert r["c3"].MLD_temp == 15.0 and r["c3"].DCM is None  # null chlorophyll below -> no DCM


def test_asof_matches_brute_force(spark):
    rnd = random.Random(3)
    base = dt.datetime(2020, 1, 1)
    left = [(i, rnd.randrange(3), base + dt.timedelta(minutes=rnd.randrange(0, 3000))) for i in range(200)]
    right = [(1000 + i, rnd.randrange(3), base + dt.timedelta(minutes=rnd.randrange(0, 3000))) for i in range(120)]
    right.append((5000, 0, right[0][2]))  # two casts at one time
    L = spark.createDataFrame(left, "id long, st long, t timestamp_ntz")
    R = spark.createDataFrame(right, "cid long, st long, t timestamp_ntz")
    got = {(r.id, r.cid) for r in asof.nearest_asof(L, R, "st", "t", "t", "id", "cid", 3.0, 6.0).collect()}
    exp = set()
    for i, st, t in left:
        cands = [(abs((rt - t).total_seconds()), rt) for _, rs, rt in right if rs == st]
        if not cands:
            exp.add((i, None))
            continue
        dmin, best = min(cands)
        if dmin / 3600 > 3.0:
            exp.add((i, None))
            continue
        for cid, rs, rt in right:
            if rs == st and rt == best:
                exp.add((i, cid))
    assert got == exp


def test_forward_asof(spark):
    pts = spark.createDataFrame([(1, 5), (2, 10), (3, 11), (4, 400), (5, 2000)], "id int, k long")
    ax = spark.createDataFrame([(x,) for x in (3, 10, 12, 700)], "a long")
    got = {r.id: r.next_value for r in asof.forward_asof(pts, ax, "k", "a", bucket=100).collect()}
    assert got == {1: 10, 2: 12, 3: 12, 4: 700, 5: None}


LAT = grid.Axis(0.0, 1.0, 6)
LON = grid.Axis(0.0, 1.0, 6)


@pytest.fixture(scope="module")
def plane(spark):
    cells = [(i, j, 2.0 * i + 3.0 * j) for i in range(6) for j in range(6)]
    return spark.createDataFrame(cells, "lat_idx int, lon_idx int, value double")


def test_bilinear_reproduces_plane(spark, plane):
    pts = spark.createDataFrame([(1, 2.0, 3.0), (2, 2.5, 3.0), (3, 1.25, 4.75), (4, 5.0, 5.0), (5, 5.5, 1.0)],
                                "id int, lat double, lon double")
    got = {r.id: r.value for r in grid.grid_bilinear(pts, plane, "id", "lat", "lon", LAT, LON).collect()}
    assert got[1] == 13.0 and got[2] == 14.0 and abs(got[3] - (2.5 + 14.25)) < 1e-12
    assert got[4] == 25.0          # on the last node: no neighbour needed (D-09)
    assert got[5] is None          # outside the grid


def test_box_n1_equals_nearest(spark, plane):
    pts = spark.createDataFrame([(1, 2.2, 3.7), (2, 0.1, 5.9)], "id int, lat double, lon double")
    box = {r.id: r.value for r in grid.grid_box(pts, plane, "id", "lat", "lon", LAT, LON, 1).collect()}
    near = {r.id: r.value for r in grid.grid_nearest(pts, plane, "id", "lat", "lon", LAT, LON).collect()}
    assert box == near == {1: 2 * 2 + 3 * 4.0, 2: 15.0}
    b3 = {r.id: r.value for r in grid.grid_box(pts, plane, "id", "lat", "lon", LAT, LON, 3).collect()}
    assert b3[1] == 16.0                      # centred 3x3 mean of a plane = centre value
    assert b3[2] == (2 * 0.5 + 3 * 4.5)       # box past the border: only inside cells


def test_trend_and_first_layer_null(spark):
    rows = [(0, 0, t, 1.0 + 2.0 * t) for t in range(5)] + [(0, 1, t, None if t == 0 else 3.0) for t in range(5)] \
        + [(1, 0, t, 7.0) for t in range(5)]
    g = spark.createDataFrame(rows, "lat_idx int, lon_idx int, t int, value double")
    got = {(r.lat_idx, r.lon_idx): r.slope for r in grid.grid_trend(g, "t").collect()}
    assert got == {(0, 0): 2.0, (0, 1): None, (1, 0): 0.0}


def test_polygons(spark):
    verts = []
    shapes = {1: [(0, 0), (4, 0), (4, 4), (0, 4)],                                       # convex
              2: [(5, 0), (9, 0), (9, 4), (8, 4), (8, 1), (6, 1), (6, 4), (5, 4)],     # concave U
              3: [(0, 5), (6, 5), (6, 9), (0, 9)], 4: [(4, 0), (5, 0), (5, 4), (4, 4)]}  # 4 touches 1 and 2
    for pid, pts in shapes.items():
        verts += [(pid, 1, i, float(x), float(y)) for i, (x, y) in enumerate(pts)]
    verts += [(3, 2, i, float(x), float(y)) for i, (x, y) in enumerate([(2, 6), (4, 6), (4, 8), (2, 8)])]  # hole
    V = spark.createDataFrame(verts, "polygon_id long, ring_id int, vertex_no int, x double, y double")
    A = spark.createDataFrame([(p, p, f"P{p}") for p in shapes], "polygon_id long, ord int, name string")
    pts = [(1, 2.0, 2.0), (2, 7.0, 2.0), (3, 5.5, 0.5), (4, 3.0, 7.0), (5, 1.0, 6.0), (6, 4.0, 2.0), (7, 20.0, 20.0)]
    P = spark.createDataFrame(pts, "id int, x double, y double")
    got = {r.id: r.name for r in regions.overlay(P, "x", "y", V, A, order="ord", attr_cols=["name"]).collect()}
    assert got == {1: "P1", 2: None, 3: "P2", 4: None, 5: "P3", 6: "P1", 7: None}


def test_zone_by_coordinates_then_utc(spark):
    # J-17 for free points: overlay on zone polygons (J-14), then a per-row local -> UTC (F-03)
    from pelagic.functions.timeops import local_to_utc
    boxes = {1: ("Australia/Perth", [(112, -36), (129, -36), (129, -13), (112, -13)]),
             2: ("Australia/Sydney", [(129, -44), (154, -44), (154, -10), (129, -10)])}
    V = spark.createDataFrame([(pid, 1, i, float(x), float(y)) for pid, (_, pts) in boxes.items()
                               for i, (x, y) in enumerate(pts)],
                              "polygon_id long, ring_id int, vertex_no int, x double, y double")
    A = spark.createDataFrame([(pid, pid, z) for pid, (z, _) in boxes.items()], "polygon_id long, ord int, tz string")
    P = spark.createDataFrame([(1, 115.4, -32.0, dt.datetime(2020, 7, 7, 14, 0)),
                               (2, 148.2, -42.6, dt.datetime(2020, 1, 5, 9, 30)),
                               (3, 0.0, 0.0, dt.datetime(2020, 1, 1, 0, 0))],
                              "id int, lon double, lat double, local timestamp_ntz")
    z = regions.overlay(P, "lon", "lat", V, A, order="ord", attr_cols=["tz"])
    got = {r.id: (r.tz, r.utc) for r in z.withColumn("utc", local_to_utc("local", F.col("tz"))).collect()}
    assert got == {1: ("Australia/Perth", dt.datetime(2020, 7, 7, 6, 0)),
                   2: ("Australia/Sydney", dt.datetime(2020, 1, 4, 22, 30)),   # daylight time, +11
                   3: (None, None)}


def test_bray_curtis_properties(spark):
    rows = [("a", "x", 4.0), ("a", "y", 9.0), ("b", "x", 4.0), ("b", "y", 9.0), ("c", "z", 1.0), ("d", "x", 1.0)]
    df = spark.createDataFrame(rows, "site string, taxon string, v double")
    pairs = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "d"), ("a", "d"), ("x", "y")], "site_i string, site_j string")
    got = {(r.site_i, r.site_j): r.bc for r in community.bray_curtis(df, pairs, "site", "taxon", "v").collect()}
    assert len(got) == 4 and got[("x", "y")] is None
    assert got[("a", "b")] == 0.0 and got[("a", "c")] == 1.0
    assert abs(got[("a", "d")] - (1 - 2 * 1 / (5 + 1))) < 1e-12


def test_sample_rows_exact_count(spark):
    df = spark.range(0, 1000, numPartitions=7)
    r = sorted((x["__draw"], x.id) for x in community.sample_rows(df, 50, "id", seed=5).collect())
    assert [d for d, _ in r] == list(range(50))
    again = community.sample_rows(df.repartition(3), 50, "id", seed=5)
    assert sorted((x["__draw"], x.id) for x in again.collect()) == r  # the layout does not matter
    once = community.sample_rows(df, 50, "id", seed=5, replace=False)
    assert len({x.id for x in once.collect()}) == 50


def test_station_indices_fixture(spark):
    from pelagic.plans import products
    trips = spark.createDataFrame([("T0", 1.0), ("T1", 2.0), ("T2", None)], "sample string, biomass double")
    zoo = spark.createDataFrame([
        ("T1", "Acartia tonsa", "Acartia", "tonsa", "COPEPOD", 2.0),
        ("T1", "Calanus spp.", "Calanus", "spp.", "COPEPOD", 3.0),      # in totals, not in diversity
        ("T1", "Noctiluca x", "Noctiluca", "x", "NON-COPEPOD", 5.0),
        ("T2", "Acartia tonsa", "Acartia", "tonsa", "COPEPOD", None),
    ], "sample string, taxon string, genus string, species string, copepod string, abund double")
    traits = spark.createDataFrame([("Acartia tonsa", 1.0, "CO"), ("Calanus spp.", 3.0, "CC")],
                                   "taxon string, size double, diet string")
    phyto = spark.createDataFrame([
        ("T1", "Ceratium", "furca", "Dinoflagellate", 10.0, 1000.0),
        ("T1", "Chaetoceros", "sp1", "Centric diatom", 30.0, 300.0),
        ("T1", "Other", "thing", "Other", 99.0, 1.0),                     # group excluded
        ("T2", "Strombidium", "y", "Ciliate", 5.0, None),                 # no biovolume: carbon unknown
    ], "sample string, genus string, species string, group string, cells double, biovolume double")
    r = {x.sample: x for x in products.station_indices(trips, zoo, phyto, traits).collect()}
    t0, t1, t2 = r["T0"], r["T1"], r["T2"]
    assert t0.ZoopAbundance == 0.0 and t0.CopeAbundance is None and t0.cope_n_species is None
    assert t0.PhytoBiomassCarbon is None and t0.phyto_shannon is None
    assert t1.ZoopAbundance == 10.0 and t1.CopeAbundance == 5.0
    assert abs(t1.AvgTotalLengthCopepod - 11.0 / 5.0) < 1e-12 and abs(t1.HerbivoreCarnivoreCopepodRatio - 0.4) < 1e-12
    assert (t1.cope_n_species, t1.cope_shannon, t1.cope_evenness) == (1, 0.0, None)
    carbon = 10 * 0.76 * 100.0 ** 0.819 + 30 * 0.288 * 10.0 ** 0.811
    assert abs(t1.PhytoBiomassCarbon - carbon) < 1e-9 and t1.AbundancePhyto == 40.0
    assert t1.DiatomDinoflagellateRatio == 0.75 and t1.AvgCellVol == 32.5
    h = -(0.25 * math.log(0.25) + 0.75 * math.log(0.75))
    assert t1.phyto_n_species == 2 and abs(t1.phyto_shannon - h) < 1e-12
    assert abs(t1.phyto_evenness - h / math.log(2)) < 1e-12
    assert t2.ZoopAbundance == 0.0 and t2.CopeAbundance == 0.0 and t2.cope_shannon == 0.0
    assert t2.PhytoBiomassCarbon is None and t2.AvgCellVol is None and t2.AbundancePhyto == 5.0
    assert t2.DiatomDinoflagellateRatio is None and t2.phyto_n_species == 1


def test_hash_rank_is_a_bijection_per_group(spark):
    rows = [(g, i) for g in ("a", "b") for i in range(50 if g == "a" else 7)]
    df = spark.createDataFrame(rows, "g string, i int")
    for ranges in (1, 4, 16):
        r = community.hash_rank(df, ["g"], community.md5_key(F.lit(3), "g", "i"), ranges, tiebreak=["i"]).collect()
        by = {}
        for x in r:
            by.setdefault(x.g, []).append(x["__r"])
        assert sorted(by["a"]) == list(range(50)) and sorted(by["b"]) == list(range(7))
    one = {x.i: x["__r"] for x in community.hash_rank(df, ["g"], community.md5_key(F.lit(3), "g", "i"), 1,
                                                                  tiebreak=["i"]).collect() if x.g == "a"}
    many = {x.i: x["__r"] for x in community.hash_rank(df, ["g"], community.md5_key(F.lit(3), "g", "i"), 16,
                                                                   tiebreak=["i"]).collect() if x.g == "a"}
    assert one == many  # the rank is the hash order whatever the number of ranges


def test_envfit_permutation_p_values(spark):
    rnd = random.Random(5)
    sc = [(f"s{i}", rnd.uniform(-1, 1), rnd.uniform(-1, 1)) for i in range(40)]
    scores = spark.createDataFrame(sc, "site string, axis1 double, axis2 double")
    env = spark.createDataFrame([(s, 2 * a - b, rnd.uniform(0, 1)) for s, a, b in sc], "site string, lin double, noise double")
    r = {x.variable: x for x in community.fit_vectors_perm(scores, env, "site", ("axis1", "axis2"), ["lin", "noise"],
                                                           perm=99, seed=2, stratum=20).collect()}
    assert abs(r["lin"].r2 - 1.0) < 1e-9 and r["lin"].p_value == 0.01   # no permutation fits as well
    assert 0.01 <= r["noise"].p_value <= 1.0 and r["noise"].p_value > 0.01


def test_nearest_asof_never_clips_the_tolerance(spark):
    from pelagic.operators import asof

    t0 = dt.datetime(2020, 1, 1)
    left = spark.createDataFrame([(1, "s", t0), (2, "s", t0 + dt.timedelta(hours=100))], "id int, st string, ts timestamp_ntz")
    right = spark.createDataFrame([(9, "s", t0 + dt.timedelta(hours=36))], "cast int, st string, ts timestamp_ntz")
    near = lambda **k: {r.id: r.cast for r in asof.nearest_asof(left, right, "st", "ts", "ts", "id", "cast", **k).collect()}
    assert near(tolerance_h=48.0) == {1: 9, 2: None}
    assert near(tolerance_h=35.0) == {1: None, 2: None}
    by_row = F.when(F.col("id") == 1, F.lit(48.0))
    assert near(tolerance_h=by_row, max_tolerance_h=72.0) == {1: 9, 2: None}  # a null tolerance matches nothing
    with pytest.raises(ValueError):
        near(tolerance_h=by_row)
    with pytest.raises(Exception, match="tolerance above"):
        near(tolerance_h=by_row, max_tolerance_h=24.0)


def test_null_coordinate_and_null_date_stay_null(spark):
    from pelagic.functions.timeops import eight_day_composite
    from pelagic.operators.grid import Axis

    df = spark.createDataFrame([(None, None), (-50.0, dt.date(2020, 1, 1)), (float("nan"), dt.date(2020, 12, 31))], "x double, d date")
    assert [r[0] for r in df.select(Axis(0.0, 1.0, 5).nearest("x")).collect()] == [None, 0, None]
    c = eight_day_composite("d")
    assert [tuple(r) for r in df.select(c["comp_start_doy"], c["comp_end_doy"]).collect()] == [(None, None), (1, 8), (353, 360)]


def test_wide_has_one_form_for_any_width(spark):
    from pelagic.operators import reshape as rs

    for n in (3, 150):
        rows = [("k", f"c{i}", float(i)) for i in range(n)] + [("k", "c0", 5.0), ("j", "c1", None), ("j", "c2", float("nan"))]
        df = spark.createDataFrame(rows, "key string, col string, v double")
        w = rs.to_wide(df.where("col <> 'c0'"), ["key"], "col", "v", fill=0.0)
        assert len(w.columns) == n
        j = {r.key: r for r in w.collect()}["j"]
        assert j.c1 is None and math.isnan(j.c2)


def test_exact_quartiles(spark):
    from pelagic.operators import reshape as rs

    df = spark.createDataFrame([("a", float(x)) for x in (1, 2, 3, 10)], "t string, v double")
    r = rs.column_summary(df, "t", "v").first()
    assert (r.q1, r.median, r.q3) == (1.75, 2.5, 4.75)


def test_index_keeps_complexes_and_matrix_drops_them(spark):
    df = spark.createDataFrame([("G", "a/b"), ("G", "x y"), ("G", "spp."), ("G", "cf. z"), ("G", "w grp")], "genus string, species string")
    names = lambda drop: sorted(r.TaxonName for r in indices.species_filter(df, "genus", "species", drop).collect())
    assert names(indices.INDEX_DROP_PATTERNS) == ["G a/b", "G x"] and names(indices.MATRIX_DROP_PATTERNS) == ["G x"]


def test_axis_read_from_the_grid(spark):
    g = spark.createDataFrame([(i, -10.0 - 0.25 * i) for i in range(2, 9)], "lat_idx int, lat double")
    assert grid.axis_of(g, "lat_idx", "lat") == grid.Axis(-10.0, -0.25, 9)


IRREGULAR = [(-10.0, -9.5, -8.0, -1.0), (5.0, 4.0, 1.5, 1.25, -30.0), (3.0,), tuple(0.5 * i + 0.001 * i * i for i in range(37))]


@pytest.mark.parametrize("nodes", IRREGULAR)
def test_irregular_axis_against_brute_force(spark, nodes):
    """Nearest, edge, window and bracket of any sorted nodes: on nodes, half-way, beyond the ends, null and NaN."""
    from pelagic.operators.axes import NodeAxis

    rnd = random.Random(len(nodes))
    xs = [*nodes, *[(a + b) / 2 for a, b in zip(nodes, nodes[1:])], -99.0, 99.0, None, float("nan"), *[rnd.uniform(-12, 6) for _ in range(60)]]
    ax, up = NodeAxis(nodes), -1 if len(nodes) > 1 and nodes[1] < nodes[0] else 1
    df = spark.createDataFrame([(k, x) for k, x in enumerate(xs)], "k int, x double")
    i0, t = ax.bracket("x")
    got = df.select("k", ax.nearest("x").alias("near"), ax.floor_index("x").alias("edge"), ax.first_within("x", 0.3).alias("win"),
                    i0.alias("i0"), t.alias("t"), ax.value(ax.nearest("x")).alias("v")).collect()
    for r in got:
        x = xs[r.k]
        if x is None or x != x:
            assert (r.near, r.edge, r.win, r.i0, r.t, r.v) == (None,) * 6
            continue
        near = min(range(len(nodes)), key=lambda i: (abs(nodes[i] - x), -i))
        edge = max((i for i, v in enumerate(nodes) if v * up <= x * up), default=-1)
        win = next((i for i, v in enumerate(nodes) if x - 0.3 < v < x + 0.3), None)
        inside = min(nodes) <= x <= max(nodes)
        share = (x - nodes[edge]) / (nodes[edge + 1] - nodes[edge]) if inside and edge + 1 < len(nodes) else 0.0
        assert (r.near, r.edge, r.win, r.i0, r.t, r.v) == (near, edge, win, edge if inside else -1, share, nodes[near])


def test_axis_of_uneven_steps_is_searched(spark):
    g = spark.createDataFrame(list(enumerate([-10.0, -9.5, -8.0, -1.0])), "lat_idx int, lat double")
    ax = grid.axis_of(g, "lat_idx", "lat")
    assert ax.nodes == (-10.0, -9.5, -8.0, -1.0)
    assert spark.range(1).select(ax.nearest(F.lit(-8.0))).first()[0] == 2
    with pytest.raises(ValueError):
        grid.axis_of(g.where("lat_idx <> 1"), "lat_idx", "lat")  # a node without a row
    with pytest.raises(ValueError):
        grid.NodeAxis((1.0, 1.0, 2.0))


def test_axis_search_is_a_constant_array_and_no_join(spark):
    ax = grid.NodeAxis(tuple(0.01 * i + 1e-6 * i * i for i in range(5000)))
    p = spark.range(10).select(ax.nearest(F.col("id").cast("double")).alias("i"))._jdf.queryExecution()
    text = p.optimizedPlan().toString()
    assert "split(" not in text and "Join" not in p.executedPlan().toString()  # folded once, not per row


def test_regrid_between_irregular_axes(spark):
    """Against interpolation by hand: targets on nodes, between them, at the ends, beyond; a null and a missing cell."""
    lat, lon = grid.NodeAxis((0.0, 1.0, 4.0)), grid.NodeAxis((10.0, 8.0, 7.0, 2.0))
    cells = {(i, j): float(3 * i + j * j) for i in range(3) for j in range(4) if (i, j) != (2, 3)}
    cells[(0, 1)] = None
    g = spark.createDataFrame([("a", i, j, v) for (i, j), v in cells.items()], "layer string, lat_idx int, lon_idx int, value double")
    to_lat, to_lon = (-1.0, 0.0, 0.5, 1.0, 3.0, 4.0, 5.0), (11.0, 10.0, 9.0, 8.0, 7.5, 4.0, 2.0)

    def around(nodes, c):
        if c in nodes:
            return [(nodes.index(c), 1.0)]
        for k, (a, b) in enumerate(zip(nodes, nodes[1:])):
            if min(a, b) < c < max(a, b):
                return [(k, (b - c) / (b - a)), (k + 1, (c - a) / (b - a))]
        return []

    got = {(r.lat_idx, r.lon_idx): r.value for r in grid.regrid(g, lat, lon, grid.NodeAxis(to_lat), grid.NodeAxis(to_lon), ["layer"]).collect()}
    for a, y in enumerate(to_lat):
        for b, x in enumerate(to_lon):
            ys, xs = around(lat.nodes, y), around(lon.nodes, x)
            needed = [cells.get((i, j), "gone") for i, _ in ys for j, _ in xs]
            if all(v == "gone" for v in needed):
                assert (a, b) not in got
            elif any(v in (None, "gone") for v in needed):
                assert got[(a, b)] is None
            else:
                assert abs(got[(a, b)] - sum(p * q * cells[(i, j)] for i, p in ys for j, q in xs)) < 1e-9


@pytest.mark.parametrize("slice_rows", [5, 40, 10**6])
def test_asof_of_a_hot_station_is_cut_and_equals_brute_force(spark, slice_rows):
    """A station with most rows, one instant with many, stations without casts, null keys; edges carried over empty slices."""
    rnd = random.Random(slice_rows)
    t0 = dt.datetime(2020, 1, 1)
    at = lambda h: t0 + dt.timedelta(hours=h)
    left = [(i, "hot", at(rnd.choice([rnd.uniform(0, 900), 333.0]))) for i in range(300)]
    left += [(1000 + i, rnd.choice(["a", "b", "bare"]), at(rnd.randint(0, 40))) for i in range(90)] + [(2000, None, at(1)), (2001, "hot", None)]
    casts = [(i, "hot", at(rnd.choice([rnd.uniform(0, 100), rnd.uniform(800, 900)]))) for i in range(60)]
    casts += [(500 + i, rnd.choice(["a", "b"]), at(rnd.randint(0, 40))) for i in range(30)] + [(900, None, at(1)), (901, "hot", None)]
    L = spark.createDataFrame(left, "id long, st string, t timestamp_ntz")
    R = spark.createDataFrame(casts, "cid long, st string, t timestamp_ntz")
    for hours in (3.0, 1000.0):
        got = {(r.id, r.cid) for r in asof.nearest_asof(L, R, "st", "t", "t", "id", "cid", hours, slice_rows=slice_rows).collect()}
        want = set()
        for i, st, t in left:
            near = [(abs(c[2] - t), c[2]) for c in casts if st is not None and c[1] == st and t is not None and c[2] is not None]
            best = min(near, default=None)
            if best is None or best[0] > dt.timedelta(hours=hours):
                want.add((i, None))
            else:
                want |= {(i, c[0]) for c in casts if c[1] == st and c[2] == best[1]}
        assert got == want
    sides = L.select(F.col("st").alias("__by"), F.col("t").alias("__t")).unionByName(R.select(F.col("st").alias("__by"), F.col("t").alias("__t")))
    instants = sides.where("__by is not null and __t is not null").distinct().withColumn("__t", F.unix_micros(F.col("__t").cast("timestamp")))
    from pelagic.operators.slices import cut_slices

    n = cut_slices(instants, "__by", "__t", slice_rows).where("__by = 'hot'").groupBy("__slice").count().agg(F.count("*"), F.max("count")).first()
    assert n[0] == 1 if slice_rows == 10**6 else n[0] >= 5 and n[1] <= 200


def _inside_brute(x, y, rings):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd


@pytest.mark.parametrize("tile, depth", [(1.0, 3), (4.0, 0), (0.5, 1), (8.0, 5)])
def test_layers_against_brute_force(spark, tile, depth):
    """Stars, holes, slivers and overlaps in three layers; places on corners, edges, cell lines, far outside, null and repeated."""
    rnd = random.Random(depth)
    layers, order = {}, {}
    for name, count in (("a", 3), ("b", 2), ("c", 1)):
        for pid in range(count):
            cx, cy, n = rnd.uniform(-10, 10), rnd.uniform(-10, 10), rnd.randint(3, 16)
            star = [(round(cx + r * math.cos(6.283 * k / n), 2), round(cy + r * math.sin(6.283 * k / n), 2))
                    for k in range(n) for r in [rnd.uniform(2, 9)]]
            rings = [star] + ([[(cx - 1, cy - 1), (cx + 1, cy - 1), (cx, cy + 1)]] if pid == 0 else [])
            layers[(name, pid)], order[(name, pid)] = rings, rnd.random()
    layers[("c", 7)], order[("c", 7)] = [[(-6.0, -6.0), (6.0, -6.0), (6.0, -5.98), (-6.0, -5.98)]], -1.0
    places = [(rnd.uniform(-20, 20), rnd.uniform(-20, 20)) for _ in range(150)] + [(float(x), float(y)) for x in range(-8, 9, 2) for y in range(-8, 9, 2)]
    places += [p for rings in layers.values() for ring in rings for p in ring] + [(500.0, 3.0), (0.0, -5.99), (0.0, -6.0)]
    places += [((a[0] + b[0]) / 2, (a[1] + b[1]) / 2) for rings in layers.values() for r in rings for a, b in zip(r, r[1:])]
    places += [None, places[0]]
    pts = spark.createDataFrame([(i, *(p or (None, 1.0))) for i, p in enumerate(places)], "i int, lon double, lat double")
    v = spark.createDataFrame([(name, pid, g, str(k), x, y) for (name, pid), rings in layers.items() for g, r in enumerate(rings) for k, (x, y) in enumerate(r)],
                              "layer string, polygon_id long, ring_id int, vertex_no string, x double, y double").repartition(5)
    attrs = spark.createDataFrame([(name, pid, order[(name, pid)], f"{name}{pid}") for name, pid in layers], "layer string, polygon_id long, ord double, label string")
    got = {r.i: (r.a, r.b, r.c) for r in regions.overlay_layers(pts, "lon", "lat", v, attrs, ["a", "b", "c"], "label", "ord", tile, depth).collect()}
    assert len(got) == len(places)
    for i, p in enumerate(places):
        want = [min(((order[k], f"{k[0]}{k[1]}") for k, rings in layers.items() if k[0] == name and p and _inside_brute(*p, rings)), default=(0, None))[1]
                for name in "abc"]
        assert got[i] == tuple(want), (p, got[i], want)


def test_inner_cells_need_no_edges(spark):
    """Most places of a big polygon lie in inner cells; only those near its outline meet edges."""
    v = spark.createDataFrame([(1, 1, k, float(x), float(y)) for k, (x, y) in enumerate([(0, 0), (40, 0), (40, 40), (0, 40)])],
                              "polygon_id long, ring_id int, vertex_no int, x double, y double").withColumn("layer", F.lit(""))
    edges = regions.polygon_edges(v)
    border = regions.border_cells(edges, 0.125)
    inner = regions.inner_cells(edges, border, 1.0, 3)
    area = inner.select(F.sum(F.pow(F.lit(0.25), F.col("level"))).alias("a")).first()["a"]
    assert 39.7 ** 2 <= area < 40 ** 2 and inner.where("level = 0").count() == 38 * 38
    assert border.count() <= 4 * 2 * 324  # two rows of cells along each side at most
    plan = inner.join(spark.range(1).select(F.lit(0).alias("level"), F.lit(5).cast("long").alias("cx"), F.lit(5).cast("long").alias("cy")), ["level", "cx", "cy"])
    assert plan.count() == 1


def test_vertices_of_a_text_source_keep_their_order(spark, tmp_path):
    """16 numbered vertices written as text: 10 comes after 9, not after 1."""
    from pelagic.sources import readers

    ring = [(0, 0), (1, 0), (2, 0), (3, 0), (4, 0), (4, 1), (4, 2), (4, 3), (4, 4), (3, 4), (2, 4), (1, 4), (0, 4), (0, 3), (0, 2), (0, 1)]
    spark.createDataFrame([(1, 1, k, float(x), float(y)) for k, (x, y) in enumerate(ring)], "polygon_id int, ring_id int, vertex_no int, x double, y double") \
        .write.option("header", True).csv(f"{tmp_path}/v")
    v = readers.read_vertices(spark, f"{tmp_path}/v", "csv")
    assert dict(v.dtypes)["vertex_no"] == "bigint" and dict(v.dtypes)["x"] == "double"
    pts = spark.createDataFrame([(x + 0.5, y + 0.5) for x in range(4) for y in range(4)], "lon double, lat double")
    attrs = spark.createDataFrame([(1, "box")], "polygon_id long, region string")
    for vertices in (v, v.withColumn("vertex_no", F.col("vertex_no").cast("string"))):
        assert regions.overlay(pts, "lon", "lat", vertices, attrs, attr_cols=["region"]).where("region = 'box'").count() == 16


@pytest.mark.parametrize("slice_rows", [3, 50, 10**6])
def test_quartiles_by_selection_equal_the_built_in(spark, slice_rows):
    """A hot taxon, a hot value, few values, one value, nulls, NaN and a null taxon; slices of any size."""
    rnd = random.Random(slice_rows)
    rows = [("hot", rnd.choice([rnd.uniform(-5, 5), 1.25, rnd.choice([0.0, -2.5])])) for _ in range(900)]
    rows += [(t, float(rnd.randint(0, 9))) for t in "abcdefg" for _ in range(rnd.randint(1, 7))] + [("n", None), ("n", 3.0), ("void", None)]
    rows += [("nan", float("nan")), ("nan", 1.0), ("nan", 2.0), (None, 4.0), (None, 6.0)]
    df = spark.createDataFrame(rows, "t string, v double").repartition(7)
    got = {r.t: r.asDict() for r in reshape.column_summary(df, "t", "v", slice_rows=slice_rows).collect()}
    want = {r.t: r.asDict() for r in df.groupBy("t").agg(
        F.sum("v").alias("total"), F.min("v").alias("min"), F.max("v").alias("max"), F.avg("v").alias("mean"), F.count(F.lit(1)).alias("n"),
        *[F.percentile("v", q).alias(n) for n, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))]).collect()}
    assert set(got) == set(want)
    for t, w in want.items():
        for c, x in w.items():
            assert got[t][c] == x or (x != x and got[t][c] != got[t][c]) or (isinstance(x, float) and abs(got[t][c] - x) < 1e-9), (t, c, got[t][c], x)


def test_quartiles_hold_no_value_list(spark):
    """No aggregate keeps the distinct values of a taxon."""
    df = spark.createDataFrame([("a", 1.0)], "t string, v double")
    p = reshape.column_summary(df, "t", "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in p and "collect_" not in p


def test_random_draws_follow_ranks(spark):
    """Draw d takes the row at floor(u_d n) of the md5 order, wherever rows lie; more draws than rows; no copies of rows per draw."""
    import hashlib

    key = lambda *p: int(hashlib.md5("|".join(map(str, p)).encode()).hexdigest()[:15], 16)
    ids = [f"k{i}" for i in range(157)]
    df = spark.createDataFrame([(i,) for i in ids], "id string").repartition(6)
    order = sorted(ids, key=lambda i: (key(5, i), i))
    for n, ranges in ((20, 64), (500, 8), (0, 4)):
        got = {r["__draw"]: r.id for r in community.sample_rows(df, n, "id", seed=5, ranges=ranges).collect()}
        assert got == {d: order[key(6, d) * 157 >> 60] for d in range(n)}
    assert community.sample_rows(df.limit(0), 5, "id").count() == 0
    plan = community.sample_rows(df, 1000, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan.lower()


def test_permutations_in_place_equal_brute_force(spark):
    """Strata by hash, ranks once, Feistel partners: p-values equal those of the same pairing by hand; every partner map is a bijection."""
    import numpy as np

    for m in (1, 2, 3, 7, 64, 100, 257):
        for p in (1, 2, 999):
            assert sorted(community.feistel(np.arange(m), m, p, 3).tolist()) == list(range(m))
    assert len({tuple(community.feistel(np.arange(50), 50, p, 3)) for p in range(200)}) == 200
    rnd = random.Random(8)
    s = [(i, rnd.gauss(0, 1), rnd.gauss(0, 1)) for i in range(60)]
    env = [(i, s[i][1] + rnd.gauss(0, 0.4), rnd.gauss(5, 1) if i % 7 else None) for i in range(60)]
    S = spark.createDataFrame(s, "site int, x double, y double")
    E = spark.createDataFrame(env, "site int, near double, noise double")
    for stratum in (10**6, 16):
        got = {r.variable: r for r in community.fit_vectors_perm(S, E, "site", ("x", "y"), ["near", "noise"], 99, 4, stratum).collect()}
        for k, name in ((1, "near"), (2, "noise")):
            rows = [(i, s[i][1], s[i][2], env[i][k]) for i in range(60) if env[i][k] is not None]
            n_strata = -(-len(rows) // stratum)
            order = sorted(rows, key=lambda r: (community.md5_int(4, name, r[0]), r[0]))
            cells = {}
            for r in order:
                cells.setdefault(community.md5_int(4, name, r[0]) * n_strata >> 60, []).append(r)

            def r2(pairs):
                a = np.array(pairs)
                a = a - a.mean(0)
                fit = a[:, :2] @ np.linalg.lstsq(a[:, :2], a[:, 2], rcond=None)[0]
                return (fit ** 2).sum() / (a[:, 2] ** 2).sum()

            base = r2([r[1:] for r in rows])
            ge = sum(r2([(c[o][1], c[o][2], c[q][3]) for c in cells.values()
                         for o, q in enumerate(community.feistel(np.arange(len(c)), len(c), p, 4).tolist())]) >= base for p in range(1, 100))
            assert abs(got[name].r2 - base) < 1e-9 and got[name].p_value == (ge + 1) / 100
    assert got["near"].p_value == 0.01 and got["noise"].p_value > 0.05


def test_whole_permutations_equal_brute_force(spark, catalog):
    """Without strata a permutation moves values between all sites; the registered query asks for that."""
    import numpy as np

    rnd = random.Random(9)
    s = [(i, rnd.gauss(0, 1), rnd.gauss(0, 1)) for i in range(150)]
    env = [(i, s[i][1] + rnd.gauss(0, 4), rnd.gauss(5, 1) if i % 7 else None) for i in range(150)]
    S = spark.createDataFrame(s, "site int, x double, y double")
    E = spark.createDataFrame(env, "site int, near double, noise double")
    got = {r.variable: r for r in community.fit_vectors_perm(S, E, "site", ("x", "y"), ["near", "noise"], 49, 4, None).collect()}

    def r2(pairs):
        a = np.array(pairs)
        a = a - a.mean(0)
        fit = a[:, :2] @ np.linalg.lstsq(a[:, :2], a[:, 2], rcond=None)[0]
        return (fit ** 2).sum() / (a[:, 2] ** 2).sum()

    for k, name in ((1, "near"), (2, "noise")):
        rows = [(i, s[i][1], s[i][2], env[i][k]) for i in range(150) if env[i][k] is not None]
        sites = sorted(rows, key=lambda r: (community.md5_int(4, name, r[0]), r[0]))
        base = r2([r[1:] for r in rows])
        ge = sum(r2([(a[1], a[2], b[3]) for a, b in zip(sites, sorted(rows, key=lambda r: (community.md5_int(5, name, p, r[0]), r[0])))]) >= base
                 for p in range(1, 50))
        assert abs(got[name].r2 - base) < 1e-9 and abs(got[name].p_value - (ge + 1) / 50) < 1e-12
    assert "stratum" not in catalog.ORACLES["envfit_permutation"]


@pytest.mark.parametrize("block_rows", [7, 8192])
def test_nearest_sites_equal_brute_force(spark, block_rows):
    """Ties, copies, sites that share nothing, empty sites, null and repeated records, several query blocks."""
    from pelagic.operators.nearest_sites import nearest_sites

    rnd = random.Random(block_rows)
    rows = [(i, rnd.choice("abcdefghij"), float(rnd.randint(0, 4))) for i in range(80) for _ in range(rnd.randint(1, 6))]
    rows += [(100 + i, t, v) for i in range(9) for t, v in (("a", 4.0), ("b", 9.0))] + [(200, "z", 50.0), (201, "a", 0.0), (202, "a", None), (203, "q", 900.0)]
    df = spark.createDataFrame(rows, "s int, t string, v double").repartition(4)
    x = {}
    for s, t, v in rows:
        x.setdefault(s, {}).setdefault(t, 0.0)
        x[s][t] += v or 0.0
    x = {s: {t: math.sqrt(v) for t, v in c.items() if v > 0} for s, c in x.items()}
    asked = [0, 20, 40, 60, 100, 104, 200, 201]
    want = []
    for q in asked:
        d = []
        for s, c in x.items():
            both = sum(c.values()) + sum(x[q].values())
            if s != q and both > 0:
                d.append((round(1 - 2 * sum(min(v, x[q][t]) for t, v in c.items() if t in x[q]) / both, 9) + 0.0, s))
        want += [(q, k + 1, s, bc) for k, (bc, s) in enumerate(sorted(d)[:5])]
    for query_block in (4096, 3):
        got = nearest_sites(df, spark.createDataFrame([(q,) for q in [*asked, 0, 999]], "site int"), "s", "t", "v", 5,
                            block_rows=block_rows, query_block=query_block).collect()
        assert sorted(map(tuple, got)) == sorted(want)
    assert nearest_sites(df.limit(0), df.select(F.col("s").alias("site")).limit(0), "s", "t", "v").count() == 0


def test_nearest_sites_skip_blocks_by_their_totals():
    """A block whose totals are far from a query's is not read once the query has a close match."""
    import numpy as np
    import pyarrow as pa
    from pelagic.operators.nearest_sites import _Best

    def block(total, ids):
        return pa.table({"site": pa.array(ids), "total": [float(total)] * len(ids), "taxa": [["a"]] * len(ids), "xs": [[float(total)]] * len(ids)})

    best = _Best([(1, 10.0, [(0, 10.0)])], pa.array(["a"]), [np.inf], 2)
    best.block(block(10, [2, 3, 4]), False)
    assert best.bound == [0.0]
    kept = []
    best._keep = lambda *a: kept.append(a)
    best.block(block(30, [5, 6, 7]), False)
    assert kept == []
    best.block(block(10, [8]), False)
    assert len(kept) == 1


def test_matrix_shuffles_grow_with_the_rows(spark, monkeypatch):
    """Sums are dealt by sample to partitions of bounded rows, however few partitions the session shuffles to."""
    from pelagic import session
    from pelagic.operators import changelog
    from pelagic.sources import specs

    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    had = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        day = dt.datetime(2000, 1, 1)
        samples = spark.createDataFrame([(i, day) for i in range(500)], "sample long, sample_date timestamp_ntz")
        obs = spark.createDataFrame([(i, f"g{j} x", f"g{j}", 1.0) for i in range(500) for j in range(4)], "sample long, taxon string, genus string, value double")
        log = spark.createDataFrame([("g0 x", "old x", day)], "taxon string, parent string, start_date timestamp_ntz")
        cells = changelog.absence_matrix(samples, obs, log)
        assert cells.count() == 2000 and "hashpartitioning(sample#" in (plan := cells._jdf.queryExecution().toString())
        assert ", 20), REPARTITION_BY_NUM" in plan
        tows = samples.select(F.col("sample").alias("i_Sample"), F.lit("F").alias("ProjectName"))
        counts = obs.select(F.col("sample").alias("i_Sample"), F.col("genus").alias("Header"), F.lit(1).cast("long").alias("TaxonCount"))
        wide = specs.larval_matrix(tows, counts, ["ProjectName"], "F")
        assert wide.count() == 500 and ", 20), REPARTITION_BY_NUM" in wide._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", had)


def test_absence_matrix_sums_nothing_over_a_file_split(spark, monkeypatch):
    """Records are dealt to tasks of bounded rows before the first aggregation, and a hot sample to several of them."""
    import json

    from pelagic import session
    from pelagic.operators import changelog

    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    day = dt.datetime(2000, 1, 1)
    samples = spark.createDataFrame([(i, day) for i in range(3)], "sample long, sample_date timestamp_ntz")
    obs = spark.createDataFrame([(i % 3 if i < 90 else 1, f"g{i % 2} x", f"g{i % 2}", float(i)) for i in range(2000)],
                                "sample long, taxon string, genus string, value double").coalesce(1)
    log = spark.createDataFrame([("g0 x", "old x", dt.datetime(1999, 1, 1))], "taxon string, parent string, start_date timestamp_ntz")
    cells = changelog.absence_matrix(samples, obs, log)
    want = {}
    for i in range(2000):
        k = (i % 3 if i < 90 else 1, f"g{i % 2}")
        want[k] = want.get(k, 0.0) + i
    assert {(r.sample, r.genus): r.value for r in cells.collect()} == want

    def below(node):
        return [node["class"].rsplit(".", 1)[-1]] + below(node["kids"][0]) if node["kids"] else []

    plan = json.loads(cells._jdf.queryExecution().sparkPlan().toJSON())

    def tree(at):
        node = {"class": plan[at]["class"], "kids": []}
        after = at + 1
        for _ in range(plan[at]["num-children"]):
            kid, after = tree(after)
            node["kids"].append(kid)
        return node, after

    chain = below(tree(0)[0])  # along the first children: the facts
    exchanges = [i for i, c in enumerate(chain) if c.startswith("ShuffleExchange")]
    assert len(exchanges) == 2 and not any("Aggregate" in c for c in chain[exchanges[-1]:])


def test_absence_matrix_deals_samples_without_records_to_bounded_tasks(spark, monkeypatch):
    """Few records, many samples: the samples of a task are bounded too, and every one keeps its row."""
    from pelagic import session
    from pelagic.operators import changelog

    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    day = dt.datetime(2000, 1, 1)
    samples = spark.createDataFrame([(i, day) for i in range(3000)], "sample long, sample_date timestamp_ntz")
    obs = spark.createDataFrame([(i, "g0 x", "g0", 2.0) for i in range(5)], "sample long, taxon string, genus string, value double")
    log = spark.createDataFrame([("g0 x", "old x", dt.datetime(1999, 1, 1))], "taxon string, parent string, start_date timestamp_ntz")
    cells, wide = changelog.absence_matrix(samples, obs, log), changelog.absence_wide(samples, obs, log)
    assert {r.sample: r.value for r in cells.collect()} == {i: 2.0 for i in range(5)}
    assert {r.sample: r.g0 for r in wide.collect()} == {i: 2.0 if i < 5 else 0.0 for i in range(3000)}
    for matrix in (cells, wide):
        assert ", 30), REPARTITION_BY_NUM" in matrix._jdf.queryExecution().toString()


def test_larval_and_raw_matrices_deal_samples_without_counts_to_bounded_tasks(spark, monkeypatch, tmp_path):
    """As above for the matrices of tows and of all taxa."""
    from pelagic import session
    from pelagic.plans import q_matrices
    from pelagic.sources import specs

    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    tows = spark.range(3000).select(F.col("id").alias("i_Sample"), F.lit("F").alias("ProjectName"))
    counts = spark.createDataFrame([(i, "h", 2) for i in range(5)], "i_Sample long, Header string, TaxonCount long")
    wide = specs.larval_matrix(tows, counts, ["ProjectName"])
    assert {r.i_Sample: r.h for r in wide.collect()} == {i: 2 if i < 5 else 0 for i in range(3000)}
    for name, rows in (("orders", spark.read.parquet("/root/testdata/sf0.01/orders.parquet")),
                       ("part", spark.read.parquet("/root/testdata/sf0.01/part.parquet")),
                       ("lineitem", spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").limit(50))):
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    cells = q_matrices.raw_matrix_long(spark, str(tmp_path))
    assert 0 < cells.count() <= 50
    for matrix, tasks in ((wide, 30), (cells, 150)):
        assert f", {tasks}), REPARTITION_BY_NUM" in matrix._jdf.queryExecution().toString()


def test_stored_records_fill_the_bytes_that_file_splits_are_cut_by(spark):
    """Records that encode to almost nothing are stored at full width, so the rows of a file split are bounded."""
    import os
    from urllib.parse import urlparse

    from pelagic.operators import changelog

    day, n = dt.datetime(2000, 1, 1), 40_000
    samples = spark.createDataFrame([(i, day) for i in range(20)], "sample long, sample_date timestamp_ntz")
    obs = spark.range(n, numPartitions=2).select((F.col("id") % 20).alias("sample"), F.lit("g0 x").alias("taxon"), F.lit("g0").alias("genus"), F.lit(1.0).alias("value"))
    log = spark.createDataFrame([("g0 x", "old x", dt.datetime(1999, 1, 1))], "taxon string, parent string, start_date timestamp_ntz")
    for matrix in (changelog.absence_matrix, changelog.absence_wide):
        cells = matrix(samples, obs, log)
        files = [urlparse(f).path for f in cells.inputFiles() if "absence-records" in f]
        assert files and sum(map(os.path.getsize, files)) >= 28 * n  # sample, start and value: 8 bytes each, the label: 4 at least
        assert {r[0]: r[-1] for r in cells.collect()} == {i: n / 20 for i in range(20)}


def test_nearest_sites_compare_few_rows_and_find_every_near_one():
    """Only rows that share a query's needed taxa are compared; the nearest are those of brute force."""
    import numpy as np
    import pyarrow as pa
    from pelagic.operators.nearest_sites import DIGITS, _Best

    rnd = random.Random(3)
    taxa = [f"t{i:02}" for i in range(40)]
    sites = [{t: math.sqrt(rnd.randint(1, 50)) for t in rnd.sample(range(40), rnd.randint(1, 6))} for _ in range(4000)]
    table = pa.table({"site": pa.array(range(4000)), "total": [sum(x.values()) for x in sites],
                      "taxa": [[taxa[t] for t in x] for x in sites], "xs": [list(x.values()) for x in sites]})
    asked = list(range(0, 4000, 50))
    queries = [(q, sum(sites[q].values()), sorted(sites[q].items(), key=lambda c: (-c[1], c[0]))) for q in asked]
    best = _Best(queries, pa.array(taxa), [np.inf] * len(asked), 5)
    for lo in range(0, 4000, 2000):
        best.block(table.slice(lo, 2000), False)
    for q, (bc, found) in zip(asked, best.found):
        want = sorted((round(1 - 2 * sum(min(v, x[t]) for t, v in sites[q].items() if t in x) / (sum(x.values()) + sum(sites[q].values())), DIGITS), s)
                      for s, x in enumerate(sites) if s != q)[:5]
        assert list(zip(bc.tolist(), found.to_pylist())) == want
    assert best.compared < 0.3 * len(asked) * 4000


@pytest.mark.parametrize("indexed", [300, 24_000_000])
def test_nearest_sites_index_sets_of_taxa(monkeypatch, indexed):
    """Narrow, wide and very wide rows, copies, more than 64 taxa, empty rows and cut blocks: as brute force."""
    import numpy as np
    import pyarrow as pa
    from pelagic.operators import nearest_sites as ns

    monkeypatch.setattr(ns, "INDEXED", indexed, raising=False)
    rnd = random.Random(indexed)
    taxa = [f"t{i:03}" for i in range(90)]
    sites = [{t: math.sqrt(rnd.randint(1, 50)) for t in rnd.sample(range(30), rnd.randint(1, 5))} for _ in range(6000)]
    sites += [{t: math.sqrt(rnd.randint(1, 50)) for t in rnd.sample(range(90), n)} for n in [17, 20, 40, 64, 65, 80] * 6]
    sites += [sites[50], sites[6000]] * 4 + [sites[100]] + [{}, {}]
    n, totals = len(sites), [sum(v for _, v in sorted(x.items())) for x in sites]
    table = pa.table({"site": pa.array(range(n)), "total": totals, "taxa": pa.array([[taxa[t] for t in sorted(x)] for x in sites], pa.list_(pa.string())),
                      "xs": pa.array([[x[t] for t in sorted(x)] for x in sites], pa.list_(pa.float64()))})
    asked = [*range(0, 6000, 100), *range(6000, 6012), n - 2]
    queries = [(q, totals[q], sorted(sites[q].items(), key=lambda c: (-c[1], c[0]))) for q in asked]
    bounds = [np.inf] * len(asked)
    for own_only in (True, False):
        best = ns._Best(queries, pa.array(taxa), bounds, 5)
        for lo in range(0, n, 4000):
            best.block(table.slice(lo, 4000), own_only)
        bounds = best.bound
    for q, found in zip(asked, best.found):
        want = sorted((round(1 - 2 * sum(min(v, x[t]) for t, v in sites[q].items() if t in x) / (totals[s] + totals[q]), ns.DIGITS) + 0.0, s)
                      for s, x in enumerate(sites) if s != q and totals[s] + totals[q] > 0)[:5]
        assert list(zip(found[0].tolist(), found[1].to_pylist())) == want


def test_nearest_sites_read_a_site_across_batches(spark):
    """A site's records may lie in several batches; unknown taxa count in the total only."""
    from pelagic.operators.nearest_sites import nearest_sites, site_rows

    had = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = [(i, t, float(i + j)) for i in range(20) for j, t in enumerate("abcdefgh"[:i % 8 + 1])] + [(3, None, 4.0), (3, "a", 1.0), (None, "a", 1.0), (30, "a", None)]
        df = spark.createDataFrame(rows, "s int, t string, v double")
        got = {r.site: dict(zip(r.taxa, r.xs)) for r in site_rows(df, "s", "t", "v", None).collect()}
        want = {i: {t: float(i + j) for j, t in enumerate("abcdefgh"[:i % 8 + 1]) if i + j > 0} for i in range(20)} | {30: {}}
        want[3] |= {None: 4.0, "a": 4.0}
        assert got == want
        near = nearest_sites(df, spark.createDataFrame([(3,)], "site int"), "s", "t", "v", 1, None).collect()
        x, t = {k: v for k, v in want[3].items() if k}, {s: sum(c.values()) for s, c in want.items()}
        bc = sorted((round(1 - 2 * sum(min(v, x[k]) for k, v in c.items() if k in x) / (t[3] + t[s]), 9), s) for s, c in want.items() if s != 3)
        assert [(r.site_i, r["rank"], r.bc, r.site_j) for r in near] == [(3, 1, *bc[0])]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", had)


def test_nearest_sites_compare_few_of_many_rows():
    """Of many narrow rows over few taxa, all in one block, only those that share most of a query are compared."""
    import numpy as np
    import pyarrow as pa
    from pelagic.operators.nearest_sites import DIGITS, _Best

    rnd = np.random.default_rng(4)
    n, taxa = 60_000, [f"t{i:02}" for i in range(64)]
    x = np.zeros((n, 64))
    for s, width in enumerate(rnd.integers(1, 9, n)):
        x[s, rnd.permutation(64)[:width]] = np.sqrt(rnd.integers(1, 51, width))
    row, code = np.nonzero(x)
    ends, total = pa.array(np.searchsorted(row, np.arange(n + 1)).astype(np.int32)), x.sum(1)
    table = pa.table({"site": pa.array(range(n)), "total": total, "taxa": pa.ListArray.from_arrays(ends, pa.array(taxa).take(pa.array(code))),
                      "xs": pa.ListArray.from_arrays(ends, pa.array(x[row, code]))})
    asked = list(range(0, n, 600))
    best = _Best([(q, total[q], sorted(((c, x[q, c]) for c in np.flatnonzero(x[q]).tolist()), key=lambda c: (-c[1], c[0]))) for q in asked],
                 pa.array(taxa), [np.inf] * len(asked), 5)
    best.block(table, False)
    for q, (bc, found) in zip(asked, best.found):
        want = np.round(1 - 2 * np.minimum(x, x[q]).sum(1) / (total + total[q]), DIGITS)
        want[q] = 9
        first = np.lexsort((np.arange(n), want))[:5]
        assert found.to_pylist() == first.tolist() and np.allclose(bc, want[first], rtol=0, atol=1e-9)
    assert best.compared < 0.015 * len(asked) * n
