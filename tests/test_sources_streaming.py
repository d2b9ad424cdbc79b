"""Sources, sinks and the streaming path on small files written to a temporary folder."""

import datetime as dt
import os
import shutil

from pyspark.sql import functions as F

from pelagic.sources import readers as rd
from pelagic.sources import sinks as sk
from pelagic.streaming import incremental as inc


def test_station_source_null_token_and_filter(spark, tmp_path):
    p = tmp_path / "stations.csv"
    p.write_text(
        "PROJECTNAME,STATIONCODE,STATIONNAME,NODE,STATECODE,LONGITUDE,LATITUDE,STATIONSTARTDATE,STATIONDEPTH_M,"
        "SAMPLINGEFFORT,IMCRA,IMCRA_PB,MANAGEMENTREGION\n"
        "NRS,AAA,Alpha,N1,S1,148.5,-42.5,2009-01-01 00:00:00,-88,Monthly,X,Y,Z\n"
        "NRS,BBB,Beta,N2,S2,,,,,Monthly,X,Y,Z\n"
        "OTHER,CCC,Gamma,N3,S3,1,2,2010-01-01 00:00:00,-5,Monthly,X,Y,Z\n")
    df = rd.read_source(spark, str(p), rd.STATIONS)
    rows = {r.STATIONCODE: r for r in df.collect()}
    assert set(rows) == {"AAA", "BBB"}
    assert rows["AAA"].Station == "Alpha" and rows["BBB"].Station == "Beta"
    assert rows["AAA"].StationDepth_m == -88.0 and rows["BBB"].Latitude is None
    assert rows["AAA"].STATIONSTARTDATE == dt.datetime(2009, 1, 1)


def test_satellite_null_token(spark, tmp_path):
    p = tmp_path / "sat.csv"
    p.write_text("SAMPLE,SST,CHLA,DEPTH_M\n1,15.5,(null),88\n2,(null),0.4,bad\n")
    r = {x.Sample: x for x in rd.read_source(spark, str(p), rd.SATELLITE_VALUES).collect()}
    assert r[1].CHLA is None and r[2].SST is None and r[2].Depth_m is None  # bad number -> null


def test_preamble_skip(spark, tmp_path):
    p = tmp_path / "ctd.csv"
    pre = "".join(f"% preamble line {i}\n" for i in range(29))
    p.write_text(pre + "file_id,site_code,TEMP\n1,NRSMAI,12.5\n2,NRSKAI,\n3,OTHER,9\n")
    df = rd.read_with_preamble(spark, str(p), 29, "file_id long, site_code string, TEMP double")
    got = sorted((r.file_id, r.TEMP) for r in df.where(F.col("site_code").rlike("NRS")).collect())
    assert got == [(1, 12.5), (2, None)]
    # a folder of exports: each file has its own preamble and column order
    (tmp_path / "ctd2.csv").write_text(pre + "TEMP,site_code,file_id\n7.5,NRSMAI,4\n")
    both = rd.read_with_preamble(spark, str(tmp_path), 29, "file_id long, site_code string, TEMP double")
    assert sorted((r.file_id, r.site_code, r.TEMP) for r in both.collect()) == [
        (1, "NRSMAI", 12.5), (2, "NRSKAI", None), (3, "OTHER", 9.0), (4, "NRSMAI", 7.5)]


def test_registry_read_and_sinks(spark, tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    spark.createDataFrame([(1.0,), (2.0,)], "temp double").write.parquet(str(a))
    spark.createDataFrame([(5.0,)], "temp double").write.parquet(str(b))
    files = [os.path.join(str(d), f) for d in (a, b) for f in os.listdir(d) if f.endswith(".parquet")]
    reg = spark.createDataFrame([("S1" if "/a/" in f else "S2", f) for f in files], "station string, path string")
    df = rd.read_registry(spark, reg)
    got = sorted((r.station, r.temp) for r in df.collect())
    assert got == [("S1", 1.0), ("S1", 2.0), ("S2", 5.0)]
    folders = spark.createDataFrame([("S1", str(a)), ("S2", str(b))], "station string, path string")
    assert sorted((r.station, r.temp) for r in rd.read_registry(spark, folders).collect()) == got
    out = tmp_path / "prod"
    prod = sk.prepare_product(df.withColumn("t", F.lit(dt.datetime(2020, 1, 2, 3, 4, 5))),
                              text_ts=["t"], order_by=[F.col("temp").desc()])
    sk.write_product(prod, str(out), fmt="csv")
    back = spark.read.option("header", True).csv(str(out)).collect()
    assert sorted(r.t for r in back)[0] == "2020-01-02 03:04:05" and len(back) == 3


def test_streaming_depth_bins_match_batch(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    shutil.copy("/root/testdata/sf0.001/events.parquet", src / "part-0.parquet")
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    raw = spark.readStream.schema(schema).parquet(str(src)).select(
        F.col("event_type").alias("station"), "ts", F.get_json_object("props", "$.k").cast("double").alias("depth"),
        F.col("value").alias("temp"))
    out = inc.depth_bin_stream(raw, "station", "ts", "depth", "temp")
    sink = tmp_path / "sink"
    q = (out.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start(str(sink)))
    q.awaitTermination(300)
    streamed = spark.read.parquet(str(sink))
    batch = inc.depth_bin_stream(
        spark.read.parquet(str(src)).select(F.col("event_type").alias("station"), "ts",
                                            F.get_json_object("props", "$.k").cast("double").alias("depth"),
                                            F.col("value").alias("temp")), "station", "ts", "depth", "temp")
    # append mode only emits windows closed by the watermark: every emitted row equals the batch row
    b = {(r.station, r.depth_bin, r.time): round(r.temp, 9) for r in batch.collect()}
    s = [(r.station, r.depth_bin, r.time, round(r.temp, 9)) for r in streamed.collect()]
    assert s and all(b[(st, db, t)] == v for st, db, t, v in s)


def test_registry_is_one_scan_for_any_number_of_sources(spark, tmp_path):
    """300 sources, nested folders, a name with a blank, a column that only some have; a file below two paths counts for both."""
    (tmp_path / "x y").mkdir()
    for k in range(3):
        spark.createDataFrame([(k, float(k))], "id int, temp double").coalesce(1).write.parquet(str(tmp_path / "x y" / f"s{k}" / "deep"))
    spark.createDataFrame([(9, 2.5)], "id int, salt double").coalesce(1).write.parquet(str(tmp_path / "x y" / "s9"))
    rows = [(f"S{k}", str(tmp_path / "x y" / f"s{k}")) for k in (0, 1, 9)] + [("deep", str(tmp_path / "x y" / "s1" / "deep") + "/")]
    reg = spark.createDataFrame(rows, "station string, path string")
    got = rd.read_registry(spark, reg)
    assert sorted((r.station, r.id, r.temp, r.salt) for r in got.collect()) == [
        ("S0", 0, 0.0, None), ("S1", 1, 1.0, None), ("S9", 9, None, 2.5), ("deep", 1, 1.0, None)]
    one = str(tmp_path / "x y" / "s9")
    many = spark.createDataFrame([(f"T{k}", one if k < 150 else str(tmp_path / "x y" / "s0")) for k in range(300)], "station string, path string")
    df = rd.read_registry(spark, many)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan and df.count() == 300


def _asked(spark, path, n):
    from pelagic.operators.grid import period_key

    spark.createDataFrame([(k, dt.date(2010, 1 + k % 2, 5)) for k in range(n)], "id int, day date").write.parquet(path + "-points")
    pts = spark.read.parquet(path + "-points")
    return pts, rd.asked_periods(pts, period_key("day", "1m"))


def test_only_layers_that_points_ask_for_are_read(spark, tmp_path):
    """Dynamic pruning by (product, resolution, period): the layers nobody asks for are broken files."""
    path = str(tmp_path / "g")
    g = spark.range(100).select((F.col("id") % 10).cast("int").alias("lat_idx"), (F.col("id") / 10).cast("int").alias("lon_idx"),
                                F.col("id").cast("double").alias("value"))
    layers = spark.createDataFrame([(p, "1m", f"2010-{m:02d}") for p in ("sst", "chl") for m in range(1, 7)], "product string, resolution string, period string")
    sk.write_grid(g.crossJoin(layers), path, tasks=4)
    for d, _, files in os.walk(path):
        for f in files:
            if f.endswith(".parquet") and ("product=chl" in d or not any(f"period=2010-{m}" in d for m in ("01", "02"))):
                with open(os.path.join(d, f), "wb") as out:
                    out.write(b"broken")
                crc = os.path.join(d, "." + f + ".crc")
                if os.path.exists(crc):
                    os.remove(crc)
    schema = "lat_idx int, lon_idx int, value double, product string, resolution string, period string"
    pts, asked = _asked(spark, path, 6)
    df = rd.read_grid(spark, path, ["sst"], asked, "1m", schema=schema)
    assert df.count() == 200 and {r.period for r in df.select("period").distinct().collect()} == {"2010-01", "2010-02"}
    assert "dynamicpruning" in df._jdf.queryExecution().executedPlan().toString()


def test_a_box_reads_few_row_groups(spark, tmp_path):
    """Z-order clustering: a box of a tenth by a tenth meets under a tenth of the row groups (latitude bands: over a tenth)."""
    import pyarrow.parquet as pq

    n, path = 256, str(tmp_path / "g")
    g = spark.range(n * n).select(F.lit("sst").alias("product"), F.lit("1m").alias("resolution"), F.lit("all").alias("period"),
                                  F.floor(F.col("id") / n).cast("int").alias("lat_idx"), (F.col("id") % n).cast("int").alias("lon_idx"),
                                  F.xxhash64("id").cast("double").alias("value"))
    sk.write_grid(g, path, row_group_bytes=8 * 1024, tasks=4)
    lo, hi = 100, 124
    groups = met = cells = 0
    for d, _, files in os.walk(path):
        for f in files:
            if f.endswith(".parquet"):
                m = pq.ParquetFile(os.path.join(d, f)).metadata
                for k in range(m.num_row_groups):
                    col = {m.row_group(k).column(c).path_in_schema: m.row_group(k).column(c).statistics for c in range(m.num_columns)}
                    groups += 1
                    cells += m.row_group(k).num_rows
                    met += all(col[c].min <= hi and col[c].max >= lo for c in ("lat_idx", "lon_idx"))
    assert cells == n * n and groups >= 40 and 0 < met <= 0.1 * groups
    box = rd.read_grid(spark, path).where(F.col("lat_idx").between(lo, hi) & F.col("lon_idx").between(lo, hi))
    assert box.count() == 25 * 25
    assert "PushedFilters: [IsNotNull(lat_idx), IsNotNull(lon_idx)" in box._jdf.queryExecution().executedPlan().toString()


def test_z_order_interleaves_bits(spark):
    rows = [(a, b) for a in (0, 1, 2, 3, 5, 1000, 4095) for b in (0, 1, 2, 7, 4096)]
    df = spark.createDataFrame(rows, "a int, b int").withColumn("z", sk.z_order("a", "b"))
    for r in df.collect():
        assert r.z == sum(((r.a >> k) & 1) << (2 * k + 1) | ((r.b >> k) & 1) << (2 * k) for k in range(24))
