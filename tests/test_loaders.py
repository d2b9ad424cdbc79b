"""Loaders composed from sources + QC (S-08, S-14, S-18) and projection helpers (P-01, F-08)."""

import datetime as dt

from pyspark.sql import functions as F

from pelagic.operators import project as pj
from pelagic.sources import specs


def test_trips_loader(spark, tmp_path):
    p = tmp_path / "trips.csv"
    p.write_text("PROJECTNAME,TRIP_CODE,STATION,STATIONCODE,LATITUDE,LONGITUDE,SAMPLEDATELOCAL,BIOMASS_MGM3,"
                 "SECCHI_M,SAMPLETYPE\n"
                 "NRS,MAI20200105,Maria Island,MAI,-42.6,148.2,2020-01-05 09:30:00,12.5,,PZ\n"
                 "NRS,ROT20200707,Rottnest,ROT,-32.0,115.4,2020-07-07 14:00:00,,3,P\n"
                 "CPR,X,Y,Z,0,0,2020-01-01 00:00:00,1,1,P\n")
    t = specs.load_trips(spark, str(p), {"MAI": "Australia/Hobart", "ROT": "Australia/Perth"})
    r = {x.TripCode: x for x in t.collect()}
    assert set(r) == {"MAI20200105", "ROT20200707"}
    assert r["MAI20200105"].SampleDateUTC == dt.datetime(2020, 1, 4, 22, 30)  # AEDT +11
    assert r["ROT20200707"].SampleDateUTC == dt.datetime(2020, 7, 7, 6, 0)    # AWST +8
    assert (r["MAI20200105"].Year, r["MAI20200105"].Month, r["MAI20200105"].Day) == (2020, 1, 5)
    assert r["ROT20200707"].Time_24hr == "14:00:00"


def test_chemistry_mask_and_replicates(spark, tmp_path):
    cols = list(specs.CHEMISTRY_FLAGS) + sorted(set(specs.CHEMISTRY_FLAGS.values()))
    head = "TRIP_CODE,SAMPLEDEPTH_M," + ",".join(cols)
    vals = {c: "1" for c in specs.CHEMISTRY_FLAGS}

    def row(trip, depth, sil, flag, dic="1"):
        v = dict(vals, SILICATE_UMOLL=sil, DIC_UMOLKG=dic)
        f = {c: "1" for c in set(specs.CHEMISTRY_FLAGS.values())}
        f["SILICATE_FLAG"] = flag
        return ",".join([trip, depth] + [v[c] if c in v else f[c] for c in cols])

    p = tmp_path / "chem.csv"
    p.write_text("\n".join([head, row("T1", "10", "2", "1"), row("T1", "10", "4", "1"), row("T1", "10", "100", "4"),
                            row("T1", "WC", "NaN", "1", dic="5"), row("T1", "WC", "", "1", dic="7")]) + "\n")
    c = {(r.TripCode, r.SampleDepth_m): r for r in specs.load_chemistry(spark, str(p)).collect()}
    assert c[("T1", "10")].SILICATE_UMOLL == 3.0      # flag 4 masked, mean of replicates
    assert c[("T1", "WC")].SILICATE_UMOLL is None     # NaN and empty -> null mean
    assert c[("T1", "WC")].DIC_UMOLKG == 6.0
    c2 = {(r.TripCode, r.SampleDepth_m): r for r in specs.load_chemistry(spark, str(p), sum_carbon=True).collect()}
    assert c2[("T1", "WC")].DIC_UMOLKG == 12.0        # D-03 parity option


def test_solids_prefix_and_mask(spark, tmp_path):
    p = tmp_path / "tss.csv"
    p.write_text("TRIP_CODE,SAMPLEDEPTH_M,TSS_MGL,INORGANICFRACTION_MGL,ORGANICFRACTION_MGL,SECCHIDEPTH_M,TSSFLAG\n"
                 "NRSMAI2020,10,2,1,1,5,1\nNRSMAI2020,10,(null),1,1,5,1\nNRSMAI2020,10,9,9,9,5,3\n"
                 "NRSMAI2020,(null),4,4,4,4,1\n")
    r = specs.load_solids(spark, str(p)).collect()
    assert len(r) == 1 and r[0].TripCode == "MAI2020" and r[0].TSS_MGL == 2.0 and r[0].INORGANICFRACTION_MGL == 1.0


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, "a/b/c/d")], "w int, x int, y int, z int, p string")
    assert pj.select_range(df, "x", "z", extra=["w", "y"]).columns == ["x", "y", "z", "w"]
    assert pj.select_except(df, ["x", "p"]).columns == ["w", "y", "z"]
    assert pj.select_positions(df, [4, 1]).columns == ["z", "w"]
    r = df.select(pj.path_part("p", 3).alias("a"), pj.strip_prefix(F.lit("NRSMAI"), 3).alias("b"),
                  pj.first_chars(F.lit("DARWIN"), 3).alias("c")).first()
    assert (r.a, r.b, r.c) == ("c", "MAI", "DAR")


def test_ctd_loader_matches_casts_to_trips(spark, tmp_path):
    p = tmp_path / "ctd.csv"
    pre = "".join(f"% preamble line {i}\n" for i in range(29))
    given = ["cruise_id", "file_id", "site_code", "time_coverage_start", "LATITUDE", "LONGITUDE", "DEPTH", "TEMP",
             "CPHL", "CHLF"]
    rest = [c.split()[0] for c in specs.CTD.schema.split(", ") if c.split()[0] not in given]
    head = ",".join(given + rest) + "\n"
    rows = [
        "c,1,NRSMAI,2020-01-05 00:00:00,-42.6,148.2,1,12.5,,0.5",
        "c,2,NRSMAI,2020-01-05 00:00:00,-42.6,148.2,2,12.4,0.7,0.5",
        "c,3,NRSMAI,2020-01-20 10:00:00,-42.6,148.2,1,12.0,,",      # 4 h from its trip: no match
        "c,4,NRSNSI,2020-02-01 10:00:00,-27.3,153.6,1,24.0,,",      # 10 h, NSI allows 15 h
        "c,5,NRSDAR,2020-03-03 01:30:00,-12.4,130.8,1,30.0,,",
        "c,2117,NRSMAI,2020-01-05 00:00:00,-42.6,148.2,1,1.0,,",    # known-bad file
        "c,6,OTHER,2020-01-05 00:00:00,0,0,1,1.0,,",                 # not a reference station
        "c,7,NRSKAI,2020-04-01 00:00:00,-35.8,136.4,1,15.0,,",      # 5 h: KAI keeps 3 h
        "c,8,NRSROT,2020-05-01 00:00:00,-32.0,115.4,1,20.0,,",      # tie at 2 h: earlier cast wins
        "c,9,NRSROT,2020-05-01 04:00:00,-32.0,115.4,1,20.0,,",
        "c,10,NRSPH4,2020-01-05 00:00:00,-34.1,151.2,1,18.0,,",     # its trip is skipped
    ]
    p.write_text(pre + head + "\n".join(r + "," * len(rest) for r in rows) + "\n")
    trips = spark.createDataFrame(
        [("MAI20200105", dt.datetime(2020, 1, 5, 1, 0)), ("MAI20200120", dt.datetime(2020, 1, 20, 6, 0)),
         ("NSI20200201", dt.datetime(2020, 2, 1, 0, 0)), ("DAR20200303", dt.datetime(2020, 3, 3, 2, 0)),
         ("KAI20200401", dt.datetime(2020, 4, 1, 5, 0)), ("ROT20200501", dt.datetime(2020, 5, 1, 2, 0)),
         ("PH420200105", dt.datetime(2020, 1, 5, 0, 0))],
        "TripCode string, SampleDateUTC timestamp_ntz")
    out = specs.load_ctd(spark, str(p), trips)
    got = {r.file_id: r for r in out.collect()}
    assert {k: v.TripCode for k, v in got.items()} == {
        1: "MAI20200105", 2: "MAI20200105", 3: None, 4: "NSI20200201", 5: "DAR20200303",
        7: None, 8: "ROT20200501", 9: None, 10: None}
    assert got[1].Chla_mgm3 == 0.5 and got[2].Chla_mgm3 == 0.7  # fluorescence fills missing chlorophyll
    assert got[1].StationName == "Maria Island" and got[10].StationName == "Ningaloo"
    assert got[1].castTime_Local == dt.datetime(2020, 1, 5, 8, 0)
    assert got[1].Depth_m == 1.0 and got[1].Temperature_degC == 12.5 and got[1].Salinity_psu is None
    assert out.columns[:3] == ["file_id", "StationName", "CastTime_UTC"] and out.columns[-1] == "TripCode"


def test_key_join_null_safe(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (None, "y"), (3, "z")], "k int, r string")
    plain = {x.l: x.r for x in pj.key_join(left, right, "k").collect()}
    assert plain == {"a": "x", "b": None}                    # Spark default: null never matches
    safe = {x.l: x.r for x in pj.key_join(left, right, "k", null_safe=True).collect()}
    assert safe == {"a": "x", "b": "y"}                      # null key matches null key (N-8)
    full = pj.key_join(left, right, "k", how="full", null_safe=True)
    assert full.columns == ["k", "l", "r"]
    assert sorted((x.k or 0, x.l or "", x.r) for x in full.collect()) == [(0, "b", "y"), (1, "a", "x"), (3, "", "z")]
    assert pj.key_join(left, right, "k", how="anti", null_safe=True).count() == 0


def test_pico_larval_and_recorder_loaders(spark, tmp_path):
    p = tmp_path / "pico.csv"
    p.write_text("TRIP_CODE,SAMPLEDEPTH_M,REPLICATE,SAMPLEDATE_LOCAL,PROCHLOROCOCCUS_CELLSML,PROCHLOROCOCCUS_FLAG,"
                 "SYNECOCHOCCUS_CELLSML,SYNECOCHOCCUS_FLAG,PICOEUKARYOTES_CELLSML,PICOEUKARYOTES_FLAG\n"
                 "T1,10,1,2020-01-01 00:00:00,10,1,(null),1,5,4\nT1,10,2,2020-01-01 00:00:00,20,1,7,1,6,1\n")
    r = specs.load_pico(spark, str(p)).first()
    assert (r.PROCHLOROCOCCUS_CELLSML, r.SYNECOCHOCCUS_CELLSML, r.PICOEUKARYOTES_CELLSML) == (15.0, 7.0, 6.0)

    s = tmp_path / "larval.csv"
    names = [x.split()[0] for x in specs.LARVAL_SAMPLES.schema.split(", ")]
    row = lambda i, t: ",".join({"I_SAMPLE_ID": i, "SAMPLEDATE_LOCAL": t}.get(n, "") for n in names)
    s.write_text("\n".join([",".join(names), row("a", "2020-07-07 10:00:00"), row("b", "2020-01-07 10:00:00")]) + "\n")
    c = tmp_path / "counts.csv"
    c.write_text("I_SAMPLE_ID,TRIP_CODE,SCIENTIFICNAME,SPCODE,COMMENTS,TAXON_COUNT\na,T,Fish one,11,,3\na,T,Fish one,11,,4\n")
    samples = specs.load_larval_samples(spark, str(s))
    assert {r.i_Sample: r.SampleDateUTC.hour for r in samples.collect()} == {"a": 0, "b": 23}
    m = specs.larval_matrix(samples, specs.load_larval_counts(spark, str(c)), ["Year"])
    assert {r.i_Sample: (r.Year, r["Fish one 11"]) for r in m.collect()} == {"a": (2020, 7), "b": (2020, 0)}  # no counts: kept

    t = tmp_path / "cpr.csv"
    t.write_text("SAMPLE,ROUTE,REGION,TRIP_CODE,SAMPLETYPE,LATITUDE,LONGITUDE,PCI,BIOMASS_MGM3,SAMPLEDATEUTC\n"
                 "1,R,X,T,P,-30,150,0,1,2020-03-04 05:06:07\n2,R,X,T,(null),-30,150,0,1,2020-03-04 05:06:07\n")
    r = specs.load_recorder_trips(spark, str(t), specs.RECORDER_SAMPLES, letter="P").collect()
    assert len(r) == 1 and (r[0].Year, r[0].Month, r[0].Day, r[0].Time_24hr) == (2020, 3, 4, "05:06:07")


def test_catalogue_pick_takes_the_latest(spark):
    from pelagic.operators.mooring import catalogue_pick

    df = spark.createDataFrame([("A", "x_gridded_timeseries_2019.nc"), ("A", "x_gridded_timeseries_2021.nc"), ("A", None),
                                ("B", "y_hourly_2020.nc")], "site string, url string")
    assert [tuple(r) for r in catalogue_pick(df, "site", "url").collect()] == [("A", "x_gridded_timeseries_2021.nc")]


def test_grid_round_trip_by_layer_and_band(spark, tmp_path):
    from pelagic.sources.readers import read_grid
    from pelagic.sources.sinks import write_grid

    rows = [(p, res, "2020", i, j, float(i * j)) for p in ("sst", "chl") for res in ("1d", "1m") for i in range(20) for j in range(3)]
    g = spark.createDataFrame(rows, "product string, resolution string, period string, lat_idx int, lon_idx int, value double")
    write_grid(g, str(tmp_path / "g"), tasks=5)
    back = read_grid(spark, str(tmp_path / "g"), products=["sst"]).where("resolution = '1m'")
    assert back.count() == 60 and back.agg(F.sum("value")).first()[0] == sum(r[5] for r in rows[:60])


def test_larval_tows_take_the_zone_of_their_place(spark, tmp_path):
    """Tows in two zone polygons, outside both, and without a place; the project variant keeps its tows and their headers only."""
    cols = specs.LARVAL_SAMPLES.schema
    names = [c.split()[0] for c in cols.split(", ")]
    rows = [("1", "IMOS x", "150", "-34"), ("2", "IMOS", "115", "-32"), ("3", "other", "140", "-20"), ("4", "other", "", "")]
    text = [",".join(names)]
    for i, project, lon, lat in rows:
        v = {"I_SAMPLE_ID": i, "PROJECTNAME": project, "LONGITUDE": lon, "LATITUDE": lat, "SAMPLEDATE_LOCAL": "2015-01-10 12:00:00"}
        text.append(",".join(v.get(n, "") for n in names))
    p = tmp_path / "s.csv"
    p.write_text("\n".join(text) + "\n")
    square = lambda x, y: [(x - 2, y - 2), (x + 2, y - 2), (x + 2, y + 2), (x - 2, y + 2)]
    v = spark.createDataFrame([(k, 1, n, float(x), float(y)) for k, ring in enumerate((square(150, -34), square(115, -32))) for n, (x, y) in enumerate(ring)],
                              "polygon_id long, ring_id int, vertex_no int, x double, y double")
    a = spark.createDataFrame([(0, "Australia/Sydney"), (1, "Australia/Perth")], "polygon_id long, zone string")
    s = specs.load_larval_samples(spark, str(p), zone="UTC", zones=(v, a))
    got = {str(r.i_Sample): (r.tz, r.SampleDateUTC.hour) for r in s.collect()}
    assert got == {"1": ("Australia/Sydney", 1), "2": ("Australia/Perth", 4), "3": ("UTC", 12), "4": ("UTC", 12)}
    counts = spark.createDataFrame([("1", "a 1", 2), ("3", "b 2", 5)], "i_Sample string, Header string, TaxonCount long")
    tows = s.withColumn("i_Sample", F.col("i_Sample").cast("string"))
    m = specs.larval_matrix(tows, counts, ["ProjectName"], project="IMOS")
    assert sorted((r.i_Sample, r["a 1"]) for r in m.collect()) == [("1", 2), ("2", 0)] and "b 2" not in m.columns


def test_wide_absence_matrix_reads_the_facts_once(spark, tmp_path):
    """The sums are stored: the plan of the result has no scan of the observations."""
    from pelagic.operators import changelog as cl

    path = str(tmp_path / "obs")
    spark.createDataFrame([(1, "Aa x", "Aa", 2.0), (2, "Bb y", "Bb", 3.0), (9, "Cc z", "Cc", 1.0)],
                          "sample int, taxon string, genus string, value double").write.parquet(path)
    samples = spark.createDataFrame([(k, dt.datetime(2000 + k, 1, 1)) for k in (1, 2, 3)], "sample int, sample_date timestamp_ntz")
    log = spark.createDataFrame([("Bb y", dt.datetime(2001, 6, 1), "Qq y")], "taxon string, start_date timestamp_ntz, parent string")
    w = cl.absence_wide(samples, spark.read.parquet(path), log)
    assert w.columns == ["sample", "Aa", "Bb"]  # a label that only unknown samples have is no column
    assert path not in w._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, w.collect())) == [(1, 2.0, -999.0), (2, 0.0, 3.0), (3, 0.0, 0.0)]
