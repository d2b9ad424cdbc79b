"""Index queries over the driver tables: diversity, ratios, carbon, null-faithful sums."""

from __future__ import annotations

from pyspark.sql import functions as F

from pelagic.functions.nulls import mean_na, strict_max, strict_sum, sum0
from pelagic.operators import indices as ix
from pelagic.plans import bindings as b
from pelagic.plans.catalog import register, rounded

_OBS = b.with_ctes(b.SQL_SAMPLES, b.SQL_OBS)


# ----------------------------------------------------------------- A-11..A-13 (+ R-4, F-09)
def shannon_evenness_df(spark, sf_dir):
    s = b.samples(spark, sf_dir)
    o = ix.species_filter(b.obs(spark, sf_dir), "genus", "species", ix.INDEX_DROP_PATTERNS, label="TaxonName")
    d = ix.diversity(o, "sample", "TaxonName", "value")
    return rounded(s.select("sample").join(d, "sample", "left"))


register("shannon_evenness", bench=True, sql=_OBS + """,
f AS (SELECT sample, genus || ' ' || split_part(species, ' ', 1) AS tn, value FROM obs
      WHERE species IS NOT NULL AND species <> 'spp.'
        AND NOT regexp_matches(species, 'cf.') AND NOT regexp_matches(species, 'grp')),
n AS (SELECT sample, count(*) AS n FROM f GROUP BY sample),
x AS (SELECT sample, tn, sum(value) AS x FROM f GROUP BY sample, tn),
t AS (SELECT sample, sum(x) AS t FROM x GROUP BY sample),
h AS (SELECT x.sample, -sum(CASE WHEN x.x > 0 THEN (x.x / t.t) * ln(x.x / t.t) ELSE 0 END) + 0.0 AS h
      FROM x JOIN t USING (sample) GROUP BY x.sample)
SELECT s.sample, n.n AS n_species, round(h.h, 6) + 0.0 AS shannon,
       round(CASE WHEN n.n > 1 THEN h.h / ln(n.n) END, 6) + 0.0 AS evenness
FROM samples s LEFT JOIN n USING (sample) LEFT JOIN h USING (sample)
""")(shannon_evenness_df)


# ----------------------------------------------------------------- A-12 distinct variant
@register("richness_distinct", sql=_OBS + """
SELECT sample, count(DISTINCT taxon) AS n_taxa FROM obs GROUP BY sample
""")
def richness_distinct(spark, sf_dir):
    return ix.richness(b.obs(spark, sf_dir), "sample", "taxon", distinct=True, out="n_taxa")


# ----------------------------------------------------------------- A-09 two-class share
@register("ratio_two_class", sql=_OBS + """,
c AS (SELECT sample,
             sum(CASE WHEN grp = 'STANDARD' THEN value END) AS a,
             sum(CASE WHEN grp = 'ECONOMY' THEN value END) AS b
      FROM obs WHERE grp IN ('STANDARD', 'ECONOMY') GROUP BY sample)
SELECT sample, CASE WHEN a + b <> 0 THEN a / (a + b) END + 0.0 AS ratio FROM c
""")
def ratio_two_class(spark, sf_dir):
    # quotient of exact integer sums: identical in any engine, left unrounded
    o = b.obs(spark, sf_dir)
    return rounded(ix.class_share(o, "sample", "grp", "value", "STANDARD", "ECONOMY", out="ratio"), keep=("ratio",))


# ----------------------------------------------------------------- A-07 abundance-weighted size
@register("mean_size", sql=_OBS + """
SELECT sample, CASE WHEN sum(value) <> 0 THEN sum(size_mm * value) / sum(value) END + 0.0 AS mean_size
FROM obs GROUP BY sample
""")
def mean_size(spark, sf_dir):
    o = b.obs(spark, sf_dir)
    r = ix.ratio_of_sums(o, "sample", F.col("size_mm") * F.col("value"), F.col("value"), "mean_size")
    return rounded(r, keep=("mean_size",))  # exact integer sums -> same quotient in any engine


# ----------------------------------------------------------------- A-08 mean cell volume
@register("cell_volume", sql=_OBS + """,
o AS (SELECT sample, value, CASE WHEN flag = 7 THEN NULL ELSE round(biovolume * 100) END AS bv FROM obs)
SELECT sample, CASE WHEN sum(value) <> 0 THEN sum(bv) / sum(value) END + 0.0 AS cell_volume
FROM o WHERE bv IS NOT NULL GROUP BY sample
""")
def cell_volume(spark, sf_dir):
    # biovolume in hundredths (exact integers): the quotient of exact sums is the
    # same correctly rounded double in any engine, so it is not rounded further
    o = b.obs(spark, sf_dir).withColumn(
        "bv", F.when(F.col("flag") == 7, F.lit(None)).otherwise(F.round(F.col("biovolume") * 100)))
    return rounded(ix.mean_cell_volume(o, "sample", "value", "bv", out="cell_volume"), keep=("cell_volume",))


# ----------------------------------------------------------------- A-10 cell carbon
# Binding of the driver's part types onto the carbon coefficient groups.
_CARBON_GROUPS = {"PROMO": (0.76, 0.819), "SMALL": (0.22, 0.939)}
_CARBON_CONST = {"LARGE": 0.2}


@register("cell_carbon", sql=_OBS + """,
o AS (SELECT sample, value AS cells, biovolume / value AS v, grp FROM obs)
SELECT sample, round(sum(cells * CASE WHEN grp = 'PROMO' THEN 0.76 * pow(v, 0.819)
                                      WHEN grp = 'SMALL' THEN 0.22 * pow(v, 0.939)
                                      WHEN grp = 'LARGE' THEN 0.2
                                      ELSE 0.288 * pow(v, 0.811) END), 3) + 0.0 AS carbon
FROM o GROUP BY sample
""")
def cell_carbon(spark, sf_dir):
    o = b.obs(spark, sf_dir)
    r = ix.cell_carbon(o, "sample", "grp", "value", "biovolume", out="carbon",
                       coeffs=_CARBON_GROUPS, constants=_CARBON_CONST)
    return r.select("sample", (F.round("carbon", 3) + F.lit(0.0)).alias("carbon"))


# ----------------------------------------------------------------- A-01/A-02/A-04/A-05
@register("strict_sum_max", sql=_OBS + """,
o AS (SELECT sample, CASE WHEN flag = 7 THEN NULL ELSE value END AS v FROM obs)
SELECT sample, coalesce(sum(v), 0) AS sum0, avg(v) + 0.0 AS mean_na,
       CASE WHEN count(*) <> count(v) THEN NULL ELSE sum(v) END AS strict_sum,
       CASE WHEN count(*) <> count(v) THEN NULL ELSE max(v) END AS strict_max
FROM o GROUP BY sample
""")
def strict_sum_max(spark, sf_dir):
    o = b.obs(spark, sf_dir).withColumn(
        "v", F.when(F.col("flag") == 7, F.lit(None)).otherwise(F.col("value")))
    r = o.groupBy("sample").agg(
        sum0("v").cast("double").alias("sum0"), mean_na("v").alias("mean_na"),
        strict_sum("v").alias("strict_sum"), strict_max("v").alias("strict_max"))
    return rounded(r, keep=("mean_na",))  # mean of whole numbers: exact sum / count


# ----------------------------------------------------------------- A-19 / V-04 group totals
_EXCLUDE = ("PROMO", "ECONOMY")


@register("group_totals", sql=_OBS + """,
g AS (SELECT sample, grp, sum(value) AS value FROM obs GROUP BY sample, grp),
k AS (SELECT * FROM g WHERE grp NOT IN ('PROMO', 'ECONOMY'))
SELECT s.sample, coalesce(k.grp, 'NONE') AS grp, coalesce(k.value, 0.0) AS value
FROM samples s LEFT JOIN k USING (sample)
""")
def group_totals(spark, sf_dir):
    return ix.group_totals(b.samples(spark, sf_dir), b.obs(spark, sf_dir), "sample", "grp", "value",
                           exclude=_EXCLUDE, placeholder="NONE")


# ----------------------------------------------------------------- A-28 sex/stage re-binning
@register("relabel_resum", sql=_OBS + """
SELECT sample, genus || ' ' || split_part(species, ' ', 1) AS TaxonName, sum(value) AS value
FROM obs WHERE species IS NOT NULL AND genus IS NOT NULL GROUP BY 1, 2
""")
def relabel_resum(spark, sf_dir):
    return ix.relabel_resum(b.obs(spark, sf_dir), "sample", "genus", "species", "value")
