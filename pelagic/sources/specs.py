"""Source specifications of the inputs the source scripts read but the checkout lacks (S-08..S-18).

Column lists follow FIXTURES.md ("Read by code, not present"); renames map the
database names onto product names.  Loaders compose the generic readers with
the QC and time operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagic.functions.nulls import nan_to_null
from pelagic.functions.labels import code_map
from pelagic.functions.timeops import local_to_utc, trip_code, utc_to_local, ymd_parts
from pelagic.operators.asof import nearest_asof
from pelagic.operators.qc import exclude_ids, mask_flags, replicate_mean
from pelagic.operators.regions import zone_by_place
from pelagic.operators.reshape import pivot_values, to_wide
from pelagic.session import dealt, stored
from pelagic.sources.readers import SourceSpec, read_source, recorder_trips

# Schemas, null tokens and renames of the sources (FIXTURES.md).
TRIPS = SourceSpec(
    schema=("PROJECTNAME string, TRIP_CODE string, STATION string, STATIONCODE string, LATITUDE double, "
            "LONGITUDE double, SAMPLEDATELOCAL timestamp_ntz, BIOMASS_MGM3 double, SECCHI_M double, SAMPLETYPE string"),
    renames={"TRIP_CODE": "TripCode", "STATION": "Station", "STATIONCODE": "StationCode", "LATITUDE": "Latitude",
             "LONGITUDE": "Longitude", "SAMPLEDATELOCAL": "SampleDateLocal", "BIOMASS_MGM3": "Biomass_mgm3",
             "SECCHI_M": "Secchi_m", "SAMPLETYPE": "SampleType"},
    where="PROJECTNAME = 'NRS'",
)
PHYTO = SourceSpec(
    schema=("TRIP_CODE string, TAXON_NAME string, TAXON_GROUP string, GENUS string, SPECIES string, SPCODE string, "
            "CELL_L double, BIOVOLUME_UM3L double"),
    renames={"TRIP_CODE": "TripCode", "TAXON_NAME": "TaxonName", "TAXON_GROUP": "TaxonGroup", "GENUS": "Genus",
             "SPECIES": "Species", "CELL_L": "Cells_L", "BIOVOLUME_UM3L": "Biovolume_um3L"},
)
ZOO = SourceSpec(
    schema=("TRIP_CODE string, TAXON_NAME string, TAXON_GROUP string, TAXON_GRP01 string, GENUS string, "
            "SPECIES string, SPCODE string, ZOOP_ABUNDANCE_M3 double"),
    renames={"TRIP_CODE": "TripCode", "TAXON_NAME": "TaxonName", "TAXON_GROUP": "Copepod",
             "TAXON_GRP01": "TaxonGroup", "GENUS": "Genus", "SPECIES": "Species", "ZOOP_ABUNDANCE_M3": "ZAbund_m3"},
)
ZOO_COUNTS = SourceSpec(
    schema=("TRIP_CODE string, TAXON_NAME string, TAXON_GROUP string, TAXON_GRP01 string, GENUS string, "
            "SPECIES string, SPCODE string, COUNTS double, SAMPVOL_L double"),
    renames={"TRIP_CODE": "TripCode", "TAXON_NAME": "TaxonName", "TAXON_GROUP": "Copepod",
             "TAXON_GRP01": "TaxonGroup", "GENUS": "Genus", "SPECIES": "Species", "COUNTS": "TaxonCount",
             "SAMPVOL_L": "SampVol_L"},
)
TRAITS = SourceSpec(
    schema="TAXON_NAME string, DIET string, SIZE_MIN_MM double, SIZE_MAX_MM double, SIZE_AVE_MM double",
    renames={"TAXON_NAME": "TaxonName"},
)
CHEMISTRY = SourceSpec(
    schema=("TRIP_CODE string, SAMPLEDEPTH_M string, SILICATE_UMOLL double, NITRATE_UMOLL double, "
            "PHOSPHATE_UMOLL double, AMMONIUM_UMOLL double, NITRITE_UMOLL double, OXYGEN_UMOLL double, "
            "DIC_UMOLKG double, TALKALINITY_UMOLKG double, SALINITY_PSU double, SILICATE_FLAG int, NITRATE_FLAG int, "
            "PHOSPHATE_FLAG int, AMMONIUM_FLAG int, NITRITE_FLAG int, OXYGEN_FLAG int, CARBON_FLAG int, ALKALINITY_FLAG int, "
            "SALINITY_FLAG int"),
    renames={"TRIP_CODE": "TripCode", "SAMPLEDEPTH_M": "SampleDepth_m"},
)
PICO = SourceSpec(
    schema=("TRIP_CODE string, SAMPLEDEPTH_M string, REPLICATE int, SAMPLEDATE_LOCAL timestamp_ntz, "
            "PROCHLOROCOCCUS_CELLSML double, PROCHLOROCOCCUS_FLAG int, SYNECOCHOCCUS_CELLSML double, "
            "SYNECOCHOCCUS_FLAG int, PICOEUKARYOTES_CELLSML double, PICOEUKARYOTES_FLAG int"),
    null_value="(null)",
    renames={"TRIP_CODE": "TripCode", "SAMPLEDEPTH_M": "SampleDepth_m"},
)
PIGMENTS = SourceSpec(
    schema=("TRIP_CODE string, SAMPLEDEPTH_M string, DV_CPHL_A_AND_CPHL_A double, PIGMENTS_FLAG int, "
            "PIGMENTS_COMMENTS string"),
    null_value="(null)",
    renames={"TRIP_CODE": "TripCode", "SAMPLEDEPTH_M": "SampleDepth_m", "DV_CPHL_A_AND_CPHL_A": "Chla"},
)
SOLIDS = SourceSpec(
    schema=("TRIP_CODE string, SAMPLEDEPTH_M string, TSS_MGL double, INORGANICFRACTION_MGL double, "
            "ORGANICFRACTION_MGL double, SECCHIDEPTH_M double, TSSFLAG int"),
    null_value="(null)",
    renames={"TRIP_CODE": "TripCode", "SAMPLEDEPTH_M": "SampleDepth_m"},
)
LARVAL_SAMPLES = SourceSpec(
    schema=("I_SAMPLE_ID string, TRIP_CODE string, STATIONNAME string, PROJECTNAME string, VESSEL string, "
            "TOWTYPE string, COMMENTS string, QC_FLAG string, FLAG_COMMENT string, LATITUDE double, LONGITUDE double, "
            "VOLUME_M3 double, GEARDEPTH_M double, GEARMESH_UM double, BATHYM_M double, TEMPERATURE_C double, "
            "SALINITY double, SAMPLEDATE_LOCAL timestamp_ntz"),
    renames={"I_SAMPLE_ID": "i_Sample", "TRIP_CODE": "TripCode", "LATITUDE": "Latitude", "LONGITUDE": "Longitude",
             "SAMPLEDATE_LOCAL": "SampleDateLocal"},
)
LARVAL_COUNTS = SourceSpec(
    schema="I_SAMPLE_ID string, TRIP_CODE string, SCIENTIFICNAME string, SPCODE string, COMMENTS string, TAXON_COUNT long",
    renames={"I_SAMPLE_ID": "i_Sample", "TRIP_CODE": "TripCode", "SCIENTIFICNAME": "ScientificName",
             "TAXON_COUNT": "TaxonCount"},
)

# CTD profile export (29 preamble lines, cruise_id skipped) and the
# product names of its columns.
CTD = SourceSpec(
    schema=("file_id long, site_code string, time_coverage_start timestamp_ntz, LATITUDE double, LONGITUDE double, "
            "DEPTH double, PSAL double, PSAL_quality_control double, TEMP double, TEMP_quality_control double, "
            "DOX2 double, DOX2_quality_control double, CPHL double, CPHL_quality_control double, CHLF double, "
            "CHLU double, CHLU_quality_control double, TURB double, TURB_quality_control double, PRES_REL double, "
            "CNDC double, CNDC_quality_control double, DENS double, DENS_quality_control double"),
    renames={"time_coverage_start": "CastTime_UTC", "LATITUDE": "Latitude", "LONGITUDE": "Longitude",
             "DEPTH": "Depth_m", "PSAL": "Salinity_psu", "PSAL_quality_control": "Salinity_flag",
             "TEMP": "Temperature_degC", "TEMP_quality_control": "Temperature_flag",
             "DOX2": "DissolvedOxygen_umolkg", "DOX2_quality_control": "DissolvedOxygen_flag",
             "CPHL": "Chla_mgm3", "CPHL_quality_control": "Chla_flag", "TURB": "Turbidity_NTU",
             "TURB_quality_control": "Turbidity_flag", "PRES_REL": "Pressure_dbar", "CNDC": "Conductivity_Sm",
             "CNDC_quality_control": "Conductivity_flag", "DENS": "WaterDensity_kgm3",
             "DENS_quality_control": "WaterDensity_flag"},
    skip_lines=29,
)
CTD_COLUMNS = ["file_id", "StationName", "CastTime_UTC", "Latitude", "Longitude", "Depth_m", "Salinity_psu",
               "Salinity_flag", "Temperature_degC", "Temperature_flag", "DissolvedOxygen_umolkg",
               "DissolvedOxygen_flag", "Chla_mgm3", "Chla_flag", "Turbidity_NTU", "Turbidity_flag", "Pressure_dbar",
               "Conductivity_Sm", "Conductivity_flag", "WaterDensity_kgm3", "WaterDensity_flag"]

# Fixed values of the CTD loader: site code -> station name (any other site is
# Ningaloo); the site whose trip codes carry the cast time; known-bad cast
# files; trips left out of matching; match tolerance in hours per station
# (3 h elsewhere, Kangaroo Island included, D-05); the zone of the local cast time.
CTD_STATION_NAMES = {"NRSDAR": "Darwin", "NRSYON": "Yongala", "NRSNSI": "North Stradbroke Island",
                     "NRSPHB": "Port Hacking", "NRSMAI": "Maria Island", "NRSKAI": "Kangaroo Island",
                     "NRSESP": "Esperance", "NRSROT": "Rottnest Island"}
CTD_OTHER_STATION = "Ningaloo"
CTD_TIMED_SITE = "NRSDAR"
CTD_BAD_FILES = (2117, 2184, 2186, 2187)
CTD_SKIP_TRIPS = "PH4"
CTD_TOLERANCE_H = {"NSI": 15.0}
CTD_DEFAULT_TOLERANCE_H = 3.0
CTD_LOCAL_ZONE = "Australia/Perth"


def load_ctd(spark: SparkSession, path: str, trips: DataFrame) -> DataFrame:
    """S-16: CTD casts with the trip each cast belongs to.

    The export is read past its preamble (S-03, H-8); only national reference
    station sites are kept; the cast's own trip code is site + date (Darwin
    adds the time, F-06), the station name comes from a literal map (F-07),
    chlorophyll falls back to fluorescence (P-10), bad files are dropped
    (P-08) and the cast time is also given in local time (F-04).

    Matching (J-05, W-07): per station (first three letters of the trip code,
    letters 4-6 of the cast's code), every trip of ``trips`` (TripCode,
    SampleDateUTC; codes containing PH4 skipped) takes the cast time nearest
    its sample time, ties to the earlier cast; a match beyond the station's
    tolerance is dropped; every cast file at the matched time belongs to the
    trip.  Casts are left-joined to those (file, trip) pairs, so a cast with
    no trip keeps a null TripCode and a cast shared by two trips appears
    twice.  The source's time-zone-name column (a coordinate lookup) is not
    produced.
    """
    raw = read_source(spark, path, CTD).where(F.col("site_code").contains("NRS"))
    site = F.col("site_code")
    ctd = raw.withColumns({
        "StationName": code_map(site, CTD_STATION_NAMES, CTD_OTHER_STATION),
        "__cast_trip": trip_code(site, "CastTime_UTC", site == CTD_TIMED_SITE),
        "Chla_mgm3": F.coalesce(F.col("Chla_mgm3"), F.col("CHLF")),
        "castTime_Local": utc_to_local("CastTime_UTC", CTD_LOCAL_ZONE),
    })
    ctd = exclude_ids(ctd, "file_id", CTD_BAD_FILES).select(*CTD_COLUMNS, "castTime_Local", "__cast_trip")

    casts = ctd.select(F.substring("__cast_trip", 4, 3).alias("__st"), "CastTime_UTC", "file_id").distinct()
    samp = (trips.where(F.col("TripCode").isNotNull() & F.col("SampleDateUTC").isNotNull()
                        & ~F.col("TripCode").contains(CTD_SKIP_TRIPS))
            .select(F.substring("TripCode", 1, 3).alias("__st"), "SampleDateUTC", "TripCode").distinct()
            .withColumn("__sid", F.concat_ws("|", "TripCode", F.col("SampleDateUTC").cast("string"))))
    tol = F.lit(CTD_DEFAULT_TOLERANCE_H)
    for station, hours in CTD_TOLERANCE_H.items():
        tol = F.when(F.col("__st") == station, F.lit(hours)).otherwise(tol)
    m = nearest_asof(samp, casts, "__st", "SampleDateUTC", "CastTime_UTC", "__sid", "file_id",
                     tolerance_h=tol, max_tolerance_h=max([CTD_DEFAULT_TOLERANCE_H, *CTD_TOLERANCE_H.values()]))
    pairs = m.where(F.col("file_id").isNotNull()).select(F.col("file_id").alias("__fid"), "TripCode")
    out = ctd.drop("__cast_trip").join(pairs, F.col("file_id") == F.col("__fid"), "left")
    return out.drop("__fid")


# Chemistry measure -> quality flag column.
CHEMISTRY_FLAGS = {
    "SILICATE_UMOLL": "SILICATE_FLAG", "NITRATE_UMOLL": "NITRATE_FLAG", "PHOSPHATE_UMOLL": "PHOSPHATE_FLAG",
    "AMMONIUM_UMOLL": "AMMONIUM_FLAG", "NITRITE_UMOLL": "NITRITE_FLAG", "OXYGEN_UMOLL": "OXYGEN_FLAG",
    "DIC_UMOLKG": "CARBON_FLAG", "TALKALINITY_UMOLKG": "ALKALINITY_FLAG", "SALINITY_PSU": "SALINITY_FLAG",
}


def load_trips(spark: SparkSession, path: str, station_zones: dict[str, str]) -> DataFrame:
    """S-08: trips with Year/Month/Day, time of day, station zone and UTC sample time (F-01..F-05, J-17)."""
    t = read_source(spark, path, TRIPS)
    parts = ymd_parts("SampleDateLocal")
    tz = code_map("StationCode", station_zones)
    return t.withColumns({**parts, "tz": tz}).withColumn("SampleDateUTC", local_to_utc("SampleDateLocal", F.col("tz")))


def load_chemistry(spark: SparkSession, path: str, sum_carbon: bool = False) -> DataFrame:
    """S-14: chemistry with QC masking (P-05), replicate mean per (trip, depth) (A-17), NaN folded (S-06).

    ``sum_carbon`` reproduces the source's summing of dissolved carbon (D-03); the default averages.
    """
    c = mask_flags(nan_to_null(read_source(spark, path, CHEMISTRY)), CHEMISTRY_FLAGS)
    values = list(CHEMISTRY_FLAGS)
    return replicate_mean(c, ["TripCode", "SampleDepth_m"], values, sum_cols=("DIC_UMOLKG",) if sum_carbon else ())


def load_pigments(spark: SparkSession, path: str) -> DataFrame:
    """S-18: pigments with the good-flag keep filter (P-06), depth kept as text ('WC' allowed)."""
    from pelagic.operators.qc import keep_flags

    return keep_flags(read_source(spark, path, PIGMENTS), "PIGMENTS_FLAG")


def load_solids(spark: SparkSession, path: str) -> DataFrame:
    """S-18: suspended solids: trip-code prefix stripped, values masked by flag (D-04: masked value used),
    replicate mean per (trip, depth), rows without a depth dropped."""
    s = read_source(spark, path, SOLIDS).withColumn("TripCode", F.substring("TripCode", 4, 1 << 30))
    s = mask_flags(s, {"TSS_MGL": "TSSFLAG", "INORGANICFRACTION_MGL": "TSSFLAG", "ORGANICFRACTION_MGL": "TSSFLAG"})
    s = s.where(F.col("SampleDepth_m").isNotNull())
    return replicate_mean(s, ["TripCode", "SampleDepth_m"],
                          ["TSS_MGL", "INORGANICFRACTION_MGL", "ORGANICFRACTION_MGL", "SECCHIDEPTH_M"])


# Picoplankton measure -> quality flag column.
PICO_FLAGS = {"PROCHLOROCOCCUS_CELLSML": "PROCHLOROCOCCUS_FLAG", "SYNECOCHOCCUS_CELLSML": "SYNECOCHOCCUS_FLAG",
              "PICOEUKARYOTES_CELLSML": "PICOEUKARYOTES_FLAG"}


def load_pico(spark: SparkSession, path: str) -> DataFrame:
    """S-15: picoplankton with QC masking (P-05) and the replicate mean per (trip, depth) (A-17)."""
    p = mask_flags(nan_to_null(read_source(spark, path, PICO)), PICO_FLAGS)
    return replicate_mean(p, ["TripCode", "SampleDepth_m"], list(PICO_FLAGS))


def load_larval_samples(spark: SparkSession, path: str, zone: str = "Australia/Sydney",
                        zones: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """S-17: larval-fish tows with Year/Month/Day, the time zone of the place and the sample time in UTC (F-01..F-03, J-17).

    ``zones``: vertices and attributes (with a column ``zone``) of a time-zone
    layer; each tow takes the zone that holds it.  ``zone`` serves tows outside
    every polygon or without a place.
    """
    s = read_source(spark, path, LARVAL_SAMPLES)
    if zones is None:
        s = s.withColumn("tz", F.lit(zone))
    else:
        s = zone_by_place(s, "Longitude", "Latitude", *zones, default=zone)
    return s.withColumns({**ymd_parts("SampleDateLocal"), "SampleDateUTC": local_to_utc("SampleDateLocal", F.col("tz"))})


def load_larval_counts(spark: SparkSession, path: str) -> DataFrame:
    """S-17: larval-fish counts with the column header ``ScientificName SPCODE`` of the matrix."""
    c = read_source(spark, path, LARVAL_COUNTS)
    return c.withColumn("Header", F.concat_ws(" ", "ScientificName", "SPCODE"))


def larval_matrix(samples: DataFrame, counts: DataFrame, attributes: list[str], project: str | None = None) -> DataFrame:
    """R-8: every tow (also one without counts) and one column per header, 0 where nothing was counted.

    ``project``: only tows whose ProjectName contains it (the project product).

    The counts are read and summed once, stored by tow and header: one pass over the sums
    finds the headers, another makes the rows, both dealt by tow to partitions of bounded rows.
    """
    if project is not None:
        samples = samples.where(F.col("ProjectName").contains(project))
    sums = stored(counts.groupBy("i_Sample", "Header").agg(F.sum("TaxonCount").alias("TaxonCount")), "larval-sums")
    rows = max(sums.count(), samples.count())  # tows may outnumber the sums
    sums, samples = dealt(sums, rows, "i_Sample"), dealt(samples.select("i_Sample", *attributes), rows, "i_Sample")
    if project is not None:
        sums = sums.join(samples.select("i_Sample"), "i_Sample", "left_semi")
    wide = to_wide(sums, ["i_Sample"], "Header", "TaxonCount", pivot_values(sums, "Header"), fill=0, unique_cells=True)
    names = [c for c in wide.columns if c != "i_Sample"]
    out = samples.select("i_Sample", *attributes).join(wide, "i_Sample", "left")
    return out.select("i_Sample", *attributes, *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(c) for c in names])


def load_recorder_trips(spark: SparkSession, path: str, spec: SourceSpec, letter: str | None = None) -> DataFrame:
    """S-09: recorder samples with a sample type, Year/Month/Day and time of day of the UTC sample time."""
    r = recorder_trips(read_source(spark, path, spec), letter=letter)
    return r.withColumns(ymd_parts("SampleDateUTC"))


# S-09 recorder sample table.
RECORDER_SAMPLES = SourceSpec(
    schema=("SAMPLE string, ROUTE string, REGION string, TRIP_CODE string, SAMPLETYPE string, LATITUDE double, "
            "LONGITUDE double, PCI double, BIOMASS_MGM3 double, SAMPLEDATEUTC timestamp_ntz"),
    null_value="(null)",
    renames={"SAMPLE": "Sample", "ROUTE": "Route", "REGION": "Region", "TRIP_CODE": "TripCode", "LATITUDE": "Latitude",
             "LONGITUDE": "Longitude", "BIOMASS_MGM3": "Biomass_mgm3", "SAMPLEDATEUTC": "SampleDateUTC"},
)
