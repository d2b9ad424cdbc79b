"""Composite product queries over the driver tables (R-6 station indices)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pelagic.functions.timeops import ymd_parts
from pelagic.operators import qc
from pelagic.operators.profile import mixed_layer, surface_mean
from pelagic.plans import bindings as b
from pelagic.plans import products as pr
from pelagic.plans import q_qc as qq
from pelagic.plans.catalog import register, rounded
from pelagic.plans.q_qc import NUTRIENTS

# Fixed values of the binding: part type -> plankton taxon group.
GROUPS = {"PROMO": "Dinoflagellate", "SMALL": "Ciliate", "LARGE": "Cyanobacteria",
          "ECONOMY": "Centric diatom", "MEDIUM": "Pennate diatom", "STANDARD": "Other"}
_GROUP_SQL = ("CASE grp WHEN 'PROMO' THEN 'Dinoflagellate' WHEN 'SMALL' THEN 'Ciliate' WHEN 'LARGE' THEN 'Cyanobacteria' "
              "WHEN 'ECONOMY' THEN 'Centric diatom' WHEN 'MEDIUM' THEN 'Pennate diatom' ELSE 'Other' END")


# Fixed value of the binding: the station that the product leaves out.
EXCLUDED_STATION = 4


def observations(spark, sf_dir):
    """Both plankton sources and the counts table as one stacked frame, from one pass over the observations.

    The narrow records are dealt by sample once: the sums per taxon and per sample, both
    wide, need no shuffle of their own.
    """
    o = b.obs(spark, sf_dir).select("sample", "taxon", "genus", "species", "grp", "value", "biovolume", "flag", "discount").repartition("sample")
    m = F.create_map(*[x for k, v in GROUPS.items() for x in (F.lit(k), F.lit(v))])
    zoo = F.col("flag") % 2 == 1
    return o.select(
        "sample", zoo.alias("zoo"), (zoo & (F.col("discount") > 0.02)).alias("counted"), (~zoo).alias("phyto"),
        F.when(zoo, F.col("taxon")).alias("taxon"), "genus", "species",
        F.when(F.col("grp") == "STANDARD", F.lit("COPEPOD")).otherwise(F.lit("NON-COPEPOD")).alias("copepod"),
        F.col("value").alias("abund"), F.ceil(F.col("value") / 3).cast("double").alias("count"),
        F.element_at(m, F.col("grp")).alias("group"), F.col("value").alias("cells"),
        F.when(F.col("flag") != 6, F.floor("biovolume").cast("double")).alias("biovolume"))


def traits(spark, sf_dir):
    part = b.table(spark, sf_dir, "part")
    return part.groupBy(F.col("p_name").alias("taxon")).agg(
        F.avg("p_size").alias("size"),
        F.when(F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)) == "red", F.lit(None))
         .when(F.avg("p_size") > 25, F.lit("CC")).otherwise(F.lit("CO")).alias("diet"))


def _water(spark, sf_dir):
    """Per trip: surface cast means, mixed layer, nutrient means over the depth means, pigment of the upper 10 m.

    Casts and nutrients have few rows per trip, which sums before the shuffle do not make fewer: they are dealt by trip first.
    """
    li = b.table(spark, sf_dir, "lineitem")
    cast = li.select(F.col("l_orderkey").alias("sample"), (F.col("l_linenumber") * 4 - 1).cast("double").alias("depth"),
                     F.when(F.col("l_orderkey") % 7 == 0, F.lit(5.0)).otherwise(F.lit(10.0)).alias("ref_depth"),
                     F.col("l_quantity").alias("temp"), (F.col("l_extendedprice") / 65536 + 30).alias("salinity"),
                     F.when(F.col("l_linenumber") != 6, F.col("l_tax") * 10).alias("chl"), F.col("l_extendedprice").alias("row"))
    surface = surface_mean(cast, "sample", "depth", ["temp", "chl", "salinity"], 15.0)
    surface = surface.withColumnsRenamed({"temp": "CTD_SST", "chl": "CTDChla", "salinity": "CTDSalinity"})
    mld = mixed_layer(cast.repartition("sample"), "sample", "depth", "temp", "salinity", "chl", "ref_depth", order="row")
    nutrients = qc.mean_of_means(qq.nutrients(spark, sf_dir).repartition("trip"), "trip", "depth", list(NUTRIENTS)).withColumnRenamed("trip", "sample")
    pig = qq.pigments(spark, sf_dir).withColumn("depth", F.col("depth").cast("double"))
    pigment = surface_mean(pig, "trip", "depth", ["chla"], 10.0, inclusive=True).withColumnRenamed("trip", "sample")
    return [surface, mld, nutrients, pigment]


def _diversity_sql(name: str, where: str) -> str:
    """CTEs ``<name>n`` (records), ``<name>x`` (taxon sums) and ``<name>h`` (Shannon) of the filtered records ``pf``."""
    return f"""{name}n AS (SELECT sample, count(*) AS n FROM pf WHERE {where} GROUP BY sample),
{name}x AS (SELECT sample, tn, sum(v) AS x FROM pf WHERE {where} GROUP BY sample, tn),
{name}h AS (SELECT sample, -sum(CASE WHEN x > 0 THEN x / t * ln(x / t) ELSE 0 END) + 0.0 AS h
       FROM {name}x JOIN (SELECT sample, sum(x) AS t FROM {name}x GROUP BY sample) USING (sample) GROUP BY sample)"""


_PLANKTON_CTES = f"""zoo AS (SELECT sample, taxon, genus, species, CASE WHEN grp = 'STANDARD' THEN 'COPEPOD' ELSE 'NON-COPEPOD' END AS copepod,
               value AS abund FROM obs WHERE flag % 2 = 1),
phyto AS (SELECT sample, genus, species, {_GROUP_SQL} AS grp2, value AS cells,
                 CASE WHEN flag = 6 THEN NULL ELSE CAST(floor(biovolume) AS DOUBLE) END AS biovolume FROM obs WHERE flag % 2 = 0),
traits AS (SELECT p_name AS taxon, avg(p_size) AS size,
                  CASE WHEN split_part(p_name, ' ', 1) = 'red' THEN NULL WHEN avg(p_size) > 25 THEN 'CC' ELSE 'CO' END AS diet
           FROM part GROUP BY p_name),
tz AS (SELECT s.sample, coalesce(sum(z.abund), 0) AS ZoopAbundance FROM samples s LEFT JOIN zoo z USING (sample) GROUP BY s.sample),
tc AS (SELECT sample, sum(abund) AS CopeAbundance FROM zoo WHERE copepod = 'COPEPOD' GROUP BY sample),
sz AS (SELECT z.sample, sum(t.size * z.abund) / sum(z.abund) AS AvgTotalLengthCopepod
       FROM zoo z JOIN traits t USING (taxon) WHERE z.copepod = 'COPEPOD' GROUP BY z.sample),
hc AS (SELECT sample, sum(abund) FILTER (WHERE d = 'CO') AS co, sum(abund) FILTER (WHERE d = 'CC') AS cc FROM (
         SELECT z.sample, z.abund, CASE WHEN t.diet = 'CC' THEN 'CC' ELSE 'CO' END AS d
         FROM zoo z JOIN traits t USING (taxon) WHERE z.copepod = 'COPEPOD' AND t.diet IS NOT NULL AND z.abund IS NOT NULL)
       GROUP BY sample),
counts AS (SELECT sample, genus, species, CASE WHEN grp = 'STANDARD' THEN 'COPEPOD' ELSE 'NON-COPEPOD' END AS copepod,
                  CAST(ceil(value / 3) AS DOUBLE) AS n FROM obs WHERE flag % 2 = 1 AND discount > 0.02),
zf AS (SELECT sample, genus || ' ' || split_part(species, ' ', 1) AS tn, n AS v FROM counts
       WHERE copepod = 'COPEPOD' AND species IS NOT NULL AND species <> 'spp.' AND NOT regexp_matches(species, 'cf.')
         AND NOT regexp_matches(species, 'grp')),
zn AS (SELECT sample, count(*) AS n FROM zf GROUP BY sample),
zx AS (SELECT sample, tn, sum(v) AS x FROM zf GROUP BY sample, tn),
zh AS (SELECT sample, -sum(CASE WHEN x > 0 THEN x / t * ln(x / t) ELSE 0 END) + 0.0 AS h
       FROM zx JOIN (SELECT sample, sum(x) AS t FROM zx GROUP BY sample) USING (sample) GROUP BY sample),
p AS (SELECT * FROM phyto WHERE grp2 <> 'Other'),
pc AS (SELECT sample,
              CASE WHEN count(*) <> count(c) THEN NULL ELSE sum(c) END AS PhytoBiomassCarbon,
              coalesce(sum(cells), 0) AS AbundancePhyto,
              sum(cells) FILTER (WHERE grp2 IN ('Centric diatom', 'Pennate diatom')) AS dia,
              sum(cells) FILTER (WHERE grp2 = 'Dinoflagellate') AS dino
       FROM (SELECT *, cells * CASE WHEN grp2 = 'Dinoflagellate' THEN 0.76 * pow(biovolume / cells, 0.819)
                                    WHEN grp2 = 'Ciliate' THEN 0.22 * pow(biovolume / cells, 0.939)
                                    WHEN grp2 = 'Cyanobacteria' THEN 0.2
                                    ELSE 0.288 * pow(biovolume / cells, 0.811) END AS c FROM p) GROUP BY sample),
cv AS (SELECT sample, sum(biovolume) / sum(cells) AS AvgCellVol FROM p WHERE biovolume IS NOT NULL GROUP BY sample),
pf AS (SELECT sample, grp2, genus || ' ' || split_part(species, ' ', 1) AS tn, cells AS v FROM p
       WHERE species IS NOT NULL AND species <> 'spp.' AND NOT regexp_matches(species, 'cf.') AND NOT regexp_matches(species, 'grp')),
{_diversity_sql("p", "true")},
{_diversity_sql("d", "grp2 IN ('Centric diatom', 'Pennate diatom')")},
{_diversity_sql("f", "grp2 = 'Dinoflagellate'")}"""

_PLANKTON_COLUMNS = """round(tz.ZoopAbundance, 6) + 0.0 AS ZoopAbundance, round(tc.CopeAbundance, 6) + 0.0 AS CopeAbundance,
       round(sz.AvgTotalLengthCopepod, 6) + 0.0 AS AvgTotalLengthCopepod,
       round(hc.co / (hc.co + hc.cc), 6) + 0.0 AS HerbivoreCarnivoreCopepodRatio,
       zn.n AS cope_n_species, round(zh.h, 6) + 0.0 AS cope_shannon,
       round(CASE WHEN zn.n > 1 THEN zh.h / ln(zn.n) END, 6) + 0.0 AS cope_evenness,
       round(pc.PhytoBiomassCarbon, 6) + 0.0 AS PhytoBiomassCarbon, round(pc.AbundancePhyto, 6) + 0.0 AS AbundancePhyto,
       round(pc.dia / (pc.dia + pc.dino), 6) + 0.0 AS DiatomDinoflagellateRatio, cv.AvgCellVol + 0.0 AS AvgCellVol,
       pn.n AS phyto_n_species, round(ph.h, 6) + 0.0 AS phyto_shannon,
       round(CASE WHEN pn.n > 1 THEN ph.h / ln(pn.n) END, 6) + 0.0 AS phyto_evenness,
       dn.n AS diatom_n_species, round(dh.h, 6) + 0.0 AS diatom_shannon,
       round(CASE WHEN dn.n > 1 THEN dh.h / ln(dn.n) END, 6) + 0.0 AS diatom_evenness,
       fn.n AS dino_n_species, round(fh.h, 6) + 0.0 AS dino_shannon,
       round(CASE WHEN fn.n > 1 THEN fh.h / ln(fn.n) END, 6) + 0.0 AS dino_evenness"""
_PLANKTON_JOINS = "".join(f" LEFT JOIN {t} USING (sample)" for t in "tz tc sz hc zn zh pc cv pn ph dn dh fn fh".split())

_WATER_CTES = """ctd AS (
  SELECT l_orderkey AS sample, CAST(l_linenumber * 4 - 1 AS DOUBLE) AS depth, CASE WHEN l_orderkey % 7 = 0 THEN 5.0 ELSE 10.0 END AS ref_depth,
         l_quantity AS temp, l_extendedprice / 65536 + 30 AS salinity, CASE WHEN l_linenumber <> 6 THEN l_tax * 10 END AS chl, l_extendedprice AS row FROM lineitem),
surface AS (SELECT sample, avg(temp) AS CTD_SST, avg(chl) AS CTDChla, avg(salinity) AS CTDSalinity FROM ctd WHERE depth < 15 GROUP BY sample),
ref AS (SELECT * FROM (SELECT sample, depth AS rdepth, temp AS rtemp, salinity AS rsal,
          row_number() OVER (PARTITION BY sample ORDER BY abs(depth - ref_depth), depth, row) AS rn FROM ctd) WHERE rn = 1),
below AS (SELECT c.*, r.rtemp, r.rsal FROM ctd c JOIN ref r USING (sample) WHERE c.depth > r.rdepth),
mt AS (SELECT sample, depth AS MLD_temp FROM (SELECT sample, depth,
          row_number() OVER (PARTITION BY sample ORDER BY abs(temp - (rtemp - 0.4)), depth, row) AS rn FROM below) WHERE rn = 1),
ms AS (SELECT sample, depth AS MLD_sal FROM (SELECT sample, depth,
          row_number() OVER (PARTITION BY sample ORDER BY abs(salinity - (rsal - 0.03)), depth, row) AS rn FROM below) WHERE rn = 1),
mx AS (SELECT sample, max(chl) AS mchl, count(*) - count(chl) AS nnull FROM below GROUP BY sample),
dc AS (SELECT b.sample, min(b.depth) AS DCM FROM below b JOIN mx USING (sample) WHERE mx.nnull = 0 AND b.chl > 0 AND b.chl = mx.mchl GROUP BY b.sample),
nutrients AS (SELECT trip AS sample, """ + ", ".join(f"avg({n}) AS {n}" for n in NUTRIENTS) + """ FROM (
                SELECT trip, depth, """ + ", ".join(f"avg({n}) AS {n}" for n in NUTRIENTS) + """ FROM chem9 GROUP BY trip, depth) GROUP BY trip),
pigment AS (SELECT trip AS sample, avg(chla) AS chla FROM pig WHERE CAST(depth AS DOUBLE) <= 10 GROUP BY trip)"""
_WATER_COLUMNS = ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in ("CTD_SST", "CTDChla", "CTDSalinity", "MLD_temp", "MLD_sal", "DCM", *NUTRIENTS, "chla"))
_WATER_JOINS = "".join(f" LEFT JOIN {t} USING (sample)" for t in "surface mt ms dc nutrients pigment".split())

_SQL = b.with_ctes(b.SQL_SAMPLES, b.SQL_OBS, qq.SQL_PIG, qq.SQL_CHEM9, _PLANKTON_CTES, _WATER_CTES) + f"""
SELECT s.sample, s.station, s.sample_date, s.lat, s.lon, round(s.biomass, 6) + 0.0 AS biomass, CAST(year(s.sample_date) AS INTEGER) AS "Year",
       CAST(month(s.sample_date) AS INTEGER) AS "Month", CAST(day(s.sample_date) AS INTEGER) AS "Day", strftime(s.sample_date, '%H:%M:%S') AS "Time_24hr",
       {_PLANKTON_COLUMNS}, {_WATER_COLUMNS}
FROM samples s{_PLANKTON_JOINS}{_WATER_JOINS} WHERE s.station <> {EXCLUDED_STATION}
"""


# ----------------------------------------------------------------- R-6, all columns of the product
@register("station_indices", bench=True, sql=_SQL)
def station_indices(spark, sf_dir):
    trips = b.samples(spark, sf_dir).where(F.col("station") != EXCLUDED_STATION).withColumns(ymd_parts("sample_date"))
    plankton = pr.plankton_indices(observations(spark, sf_dir), traits(spark, sf_dir))
    out = pr.indices_product(trips, plankton, attributes=("station", "sample_date", "lat", "lon", "biomass", "Year", "Month", "Day", "Time_24hr"),
                             parts=_water(spark, sf_dir))
    return rounded(out, keep=("AvgCellVol", "lat", "lon"))
