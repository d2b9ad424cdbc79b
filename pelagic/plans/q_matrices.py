"""Sample x taxon matrix queries: change-log absence matrices, raw / group / larval matrices."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from pelagic.functions.nulls import first_word
from pelagic.operators import changelog as cl
from pelagic.operators import indices as ix
from pelagic.operators import reshape as rs
from pelagic.plans import bindings as b
from pelagic.plans.catalog import r6, register
from pelagic.session import dealt
from pelagic.sources.specs import larval_matrix as larval

# Fixed values of the binding: the words that make up part names, and the part types.
_COLOURS = ("blue", "cold", "hot", "large", "new", "old", "red", "small")
_THINGS = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")
_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def _in(labels) -> str:
    return "IN (" + ", ".join(f"'{x}'" for x in sorted(labels)) + ")"


_ALL = b.with_ctes(b.SQL_SAMPLES, b.SQL_OBS, b.SQL_CHANGELOG)


def _absence_ctes(label_expr: str, join_expr: str, where: str, aff_cond: str, value_expr: str = "obs.value") -> str:
    """Literal SQL transcription of R-1: samples x affected labels, CASE rules, strict sum / max; ``m`` has every cell."""
    return _ALL + f""",
aff AS (SELECT taxon, start_date FROM changelog WHERE {aff_cond}),
o AS (SELECT obs.sample, {label_expr} AS label, {value_expr} AS value, aff.start_date
      FROM obs LEFT JOIN aff ON {join_expr} = aff.taxon
      WHERE {where}),
b AS (SELECT sample, label, coalesce(sum(value), 0) AS v FROM o WHERE start_date IS NULL GROUP BY sample, label),
bs AS (SELECT b.* FROM b JOIN samples USING (sample)),
c AS (SELECT sample, start_date, label, coalesce(sum(value), 0) AS v FROM o
      WHERE start_date IS NOT NULL GROUP BY sample, start_date, label),
firsts AS (SELECT label, start_date AS first_start FROM (
             SELECT label, start_date, row_number() OVER (PARTITION BY label ORDER BY sample, start_date) AS rn
             FROM c) WHERE rn = 1),
cl AS (SELECT s.sample, s.sample_date, f.label, f.first_start, c.start_date AS cstart, c.v
       FROM samples s CROSS JOIN firsts f LEFT JOIN c ON c.sample = s.sample AND c.label = f.label),
cv AS (SELECT sample, label, CASE WHEN count(*) <> count(val) THEN NULL ELSE sum(val) END AS v FROM (
         SELECT sample, label,
                CASE WHEN coalesce(cstart, first_start) > sample_date THEN -999.0
                     WHEN coalesce(cstart, first_start) < sample_date AND v IS NULL THEN 0.0
                     ELSE v END AS val
         FROM cl) GROUP BY sample, label),
u AS (SELECT sample, label, v FROM bs UNION ALL SELECT sample, label, v FROM cv),
m AS (SELECT sample, label, CASE WHEN count(*) <> count(v) THEN NULL ELSE max(v) END AS value
      FROM u GROUP BY sample, label)
"""


def _absence_sql(label_expr: str, join_expr: str, where: str, aff_cond: str, out: str,
                 value_expr: str = "obs.value") -> str:
    """The cells that have a record."""
    return _absence_ctes(label_expr, join_expr, where, aff_cond, value_expr) + f"""
SELECT sample, label AS {out}, CAST(value AS DOUBLE) AS value FROM m SEMI JOIN o USING (sample, label)
"""


def _absence_wide_sql(label_expr: str, join_expr: str, where: str, aff_cond: str, labels) -> str:
    """Every sample, one column per label; a cell that no rule fills is 0."""
    cols = ", ".join(f"CASE WHEN count(*) FILTER (WHERE label = '{x}') = 0 THEN 0.0 "
                     f"ELSE CAST(max(value) FILTER (WHERE label = '{x}') AS DOUBLE) END AS \"{x}\"" for x in labels)
    return _absence_ctes(label_expr, join_expr, where, aff_cond) + f"""
SELECT s.sample, {cols} FROM samples s LEFT JOIN m USING (sample) GROUP BY s.sample
"""


# ----------------------------------------------------------------- R-1 genus level
@register("absence_matrix_genus", bench=True, sql=_absence_sql(
    "genus", "obs.taxon", "obs.genus IS NOT NULL AND obs.genus <> ''",
    "split_part(taxon, ' ', 1) <> split_part(parent, ' ', 1) AND taxon IS NOT NULL", "genus"))
def absence_matrix_genus(spark, sf_dir):
    return cl.absence_matrix(b.samples(spark, sf_dir), b.obs(spark, sf_dir), b.changelog(spark, sf_dir),
                             key="sample", date="sample_date", taxon="taxon", label="genus",
                             value="value", level="genus")


# ----------------------------------------------------------------- R-1 genus level, the wide matrix
_GENUS = ("genus", "obs.taxon", "obs.genus IS NOT NULL AND obs.genus <> ''",
          "split_part(taxon, ' ', 1) <> split_part(parent, ' ', 1) AND taxon IS NOT NULL")


@register("absence_matrix_genus_wide", sql=_absence_wide_sql(*_GENUS, _COLOURS))
def absence_matrix_genus_wide(spark, sf_dir):
    return cl.absence_wide(b.samples(spark, sf_dir), b.obs(spark, sf_dir), b.changelog(spark, sf_dir),
                           taxon="taxon", label="genus", level="genus")


# ----------------------------------------------------------------- R-1 copepods (species), others (taxon), recorder (genus)
_COPEPOD_WHERE = ("obs.grp = 'STANDARD' AND obs.species IS NOT NULL AND obs.species <> 'spp.' "
                  "AND NOT regexp_matches(obs.species, 'cf.') AND NOT regexp_matches(obs.species, 'grp')")


@register("absence_matrix_copepod", sql=_absence_sql(
    "genus || ' ' || split_part(species, ' ', 1)", "obs.genus || ' ' || split_part(obs.species, ' ', 1)", _COPEPOD_WHERE,
    "taxon <> parent", "TaxonName"))
def absence_matrix_copepod(spark, sf_dir):
    o = b.obs(spark, sf_dir).where(F.col("grp") == "STANDARD").withColumn("genus", first_word("genus"))  # subgenera binned, D-26
    o = ix.species_filter(o, "genus", "species", ix.INDEX_DROP_PATTERNS, label="TaxonName")  # complexes to their first word
    return cl.absence_matrix(b.samples(spark, sf_dir), o, b.changelog(spark, sf_dir), taxon="TaxonName", label="TaxonName",
                             level="name")


@register("absence_matrix_noncopepod", sql=_absence_sql(
    "obs.taxon", "obs.taxon", "obs.grp <> 'STANDARD'", "taxon <> parent", "label"))
def absence_matrix_noncopepod(spark, sf_dir):
    o = b.obs(spark, sf_dir).where(F.col("grp") != "STANDARD").withColumn("label", F.col("taxon"))
    return cl.absence_matrix(b.samples(spark, sf_dir), o, b.changelog(spark, sf_dir), taxon="taxon", label="label", level="name")


@register("absence_matrix_recorder", sql=_absence_wide_sql(
    "regexp_replace(obs.taxon, '[aeiou].*$', '')", "obs.taxon", "regexp_replace(obs.taxon, '[aeiou].*$', '') <> ''", "taxon <> parent",
    sorted({re.sub("[aeiou].*$", "", c) for c in _COLOURS} - {""})))
def absence_matrix_recorder(spark, sf_dir):
    """Labels are taxa binned by a rule (here the letters before the first vowel), so one label has taxa with several starts."""
    o = b.obs(spark, sf_dir).withColumn("label", F.regexp_replace("taxon", "[aeiou].*$", ""))
    return cl.absence_wide(b.samples(spark, sf_dir), o, b.changelog(spark, sf_dir), taxon="taxon", label="label", level="name")


# ----------------------------------------------------------------- R-1 species level
_SPECIES_WHERE = ("obs.species IS NOT NULL AND obs.species <> 'spp.' AND obs.species <> '' "
                  "AND NOT regexp_matches(obs.species, 'cf.') AND NOT regexp_matches(obs.species, '/')")


@register("absence_matrix_species", sql=_absence_sql(
    "genus || ' ' || species", "obs.genus || ' ' || obs.species", _SPECIES_WHERE, "taxon <> parent", "TaxonName"))
def absence_matrix_species(spark, sf_dir):
    o = ix.species_filter(b.obs(spark, sf_dir), "genus", "species", label="TaxonName",
                          drop=("cf.", "/"), bin_complex=False).where(F.col("species") != "")
    return cl.absence_matrix(b.samples(spark, sf_dir), o, b.changelog(spark, sf_dir),
                             key="sample", date="sample_date", taxon="TaxonName", label="TaxonName",
                             value="value", level="name")


# ----------------------------------------------------------------- R-1 species level, biovolume (D-02)
# The biovolume matrix sums biovolume for change-log taxa too (the source sums
# cell counts there, D-02).  Biovolume is counted in hundredths, whole numbers,
# so sums are exact in any engine.
@register("absence_matrix_species_biovolume", sql=_absence_sql(
    "genus || ' ' || species", "obs.genus || ' ' || obs.species", _SPECIES_WHERE, "taxon <> parent", "TaxonName",
    value_expr="round(obs.biovolume * 100)"))
def absence_matrix_species_biovolume(spark, sf_dir):
    o = b.obs(spark, sf_dir).withColumn("value", F.round(F.col("biovolume") * 100))
    o = ix.species_filter(o, "genus", "species", label="TaxonName",
                          drop=("cf.", "/"), bin_complex=False).where(F.col("species") != "")
    return cl.absence_matrix(b.samples(spark, sf_dir), o, b.changelog(spark, sf_dir),
                             key="sample", date="sample_date", taxon="TaxonName", label="TaxonName",
                             value="value", level="name")


# ----------------------------------------------------------------- R-2 raw matrix (wide, fill 0)
_RAW_SQL = b.with_ctes(b.SQL_SAMPLES, b.SQL_OBS) + """,
sums AS (SELECT sample, taxon, sum(value) AS value FROM obs GROUP BY sample, taxon),
taxa AS (SELECT c || ' ' || t AS taxon FROM (SELECT unnest(""" + str(list(_COLOURS)) + """) AS c), (SELECT unnest(""" + str(list(_THINGS)) + """) AS t)),
dense AS (SELECT s.sample, t.taxon, coalesce(x.value, 0.0) AS value
          FROM samples s CROSS JOIN taxa t LEFT JOIN sums x ON x.sample = s.sample AND x.taxon = t.taxon)
PIVOT dense ON taxon """ + _in(f"{c} {t}" for c in _COLOURS for t in _THINGS) + """ USING sum(value) GROUP BY sample
"""


@register("raw_matrix_wide", sql=_RAW_SQL)
def raw_matrix_wide(spark, sf_dir):
    s = b.samples(spark, sf_dir).select("sample")
    o = b.obs(spark, sf_dir)
    sums = o.groupBy("sample", "taxon").agg(F.sum("value").alias("value"))
    return rs.to_wide(s.join(sums, "sample", "left"), ["sample"], "taxon", "value", values=rs.pivot_values(o, "taxon"), fill=0.0,
                      unique_cells=True)


# ----------------------------------------------------------------- R-2 long, sparse (zeros belong to the wide sink)
@register("raw_matrix_long", sql=b.with_ctes(b.SQL_SAMPLES, b.SQL_OBS) + """,
x AS (SELECT o.sample, o.taxon, o.value FROM samples s JOIN obs o USING (sample))
SELECT sample, taxon, coalesce(sum(value), 0.0) AS value FROM x GROUP BY sample, taxon
""")
def raw_matrix_long(spark, sf_dir):
    o, s = b.obs(spark, sf_dir), b.samples(spark, sf_dir).select("sample")
    rows = max(o.count(), s.count())  # no fewer than the cells; summed first, so a hot sample arrives as its taxa
    cells = dealt(rs.sparse_matrix(o, "sample", "taxon", "value"), rows, "sample")
    return cells.join(dealt(s, rows, "sample"), "sample", "left_semi")


# ----------------------------------------------------------------- R-3 group matrix (wide)
@register("group_totals_wide", sql=b.with_ctes(b.SQL_SAMPLES, b.SQL_OBS) + """,
g AS (SELECT sample, grp, sum(value) AS value FROM obs GROUP BY sample, grp),
k AS (SELECT * FROM g WHERE grp NOT IN ('PROMO', 'ECONOMY')),
l AS (SELECT s.sample, coalesce(k.grp, 'NONE') AS grp, coalesce(k.value, 0.0) AS value
      FROM samples s LEFT JOIN k USING (sample))
SELECT sample,
       coalesce(sum(value) FILTER (WHERE grp = 'LARGE'), 0.0) AS "LARGE",
       coalesce(sum(value) FILTER (WHERE grp = 'MEDIUM'), 0.0) AS "MEDIUM",
       coalesce(sum(value) FILTER (WHERE grp = 'NONE'), 0.0) AS "NONE",
       coalesce(sum(value) FILTER (WHERE grp = 'SMALL'), 0.0) AS "SMALL",
       coalesce(sum(value) FILTER (WHERE grp = 'STANDARD'), 0.0) AS "STANDARD"
FROM l GROUP BY sample
""")
def group_totals_wide(spark, sf_dir):
    long = ix.group_totals(b.samples(spark, sf_dir), b.obs(spark, sf_dir), "sample", "grp", "value",
                           exclude=("PROMO", "ECONOMY"), placeholder="NONE")
    return rs.to_wide(long, ["sample"], "grp", "value", fill=0.0, unique_cells=True)


# ----------------------------------------------------------------- R-8 larval-fish count matrices: all tows, and those of a project
# Binding: tow = sample, project = order status, header = part type and colour, count = rounded quantity.
def _larval_sql(where: str) -> str:
    return b.with_ctes(b.SQL_SAMPLES, b.SQL_OBS) + f""",
tows AS (SELECT sample, sample_date, sample_type FROM samples WHERE {where}),
c AS (SELECT s.sample, o.grp || ' ' || o.genus AS header, CAST(o.value AS BIGINT) AS value FROM tows s JOIN obs o USING (sample)),
sums AS (SELECT sample, header, sum(value) AS value FROM c GROUP BY sample, header),
hdr AS (SELECT g || ' ' || c AS header FROM (SELECT unnest(""" + str(list(_TYPES)) + """) AS g), (SELECT unnest(""" + str(list(_COLOURS)) + """) AS c)),
dense AS (SELECT s.sample, s.sample_date, s.sample_type, h.header, CAST(coalesce(x.value, 0) AS BIGINT) AS value
          FROM tows s CROSS JOIN hdr h LEFT JOIN sums x ON x.sample = s.sample AND x.header = h.header)
PIVOT dense ON header """ + _in(f"{g} {c}" for g in _TYPES for c in _COLOURS) + """ USING max(value) GROUP BY sample, sample_date, sample_type
"""


def _larval(spark, sf_dir, project):
    s = b.samples(spark, sf_dir).select(F.col("sample").alias("i_Sample"), "sample_date", F.col("sample_type").alias("ProjectName"))
    o = b.obs(spark, sf_dir).select(F.col("sample").alias("i_Sample"), F.concat_ws(" ", "grp", "genus").alias("Header"),
                                    F.col("value").cast("long").alias("TaxonCount"))
    m = larval(s, o, ["sample_date", "ProjectName"], project)
    return m.withColumnsRenamed({"i_Sample": "sample", "ProjectName": "sample_type"})


@register("larval_matrix", sql=_larval_sql("true"))
def larval_matrix(spark, sf_dir):
    return _larval(spark, sf_dir, None)


@register("larval_matrix_project", sql=_larval_sql("sample_type LIKE '%F%'"))
def larval_matrix_project(spark, sf_dir):
    return _larval(spark, sf_dir, "F")


# ----------------------------------------------------------------- P-15 drop all-zero taxa
@register("drop_empty_taxa", sql=b.with_ctes(b.SQL_OBS) + """,
m AS (SELECT sample, grp, CASE WHEN grp = 'PROMO' THEN 0.0 ELSE value END AS v FROM obs),
keep AS (SELECT grp FROM m GROUP BY grp HAVING sum(v) <> 0)
SELECT m.* FROM m WHERE grp IN (SELECT grp FROM keep)
""")
def drop_empty_taxa(spark, sf_dir):
    m = b.obs(spark, sf_dir).select(
        "sample", "grp", F.when(F.col("grp") == "PROMO", F.lit(0.0)).otherwise(F.col("value")).alias("v"))
    return rs.drop_empty_taxa(m, "grp", "v")


# ----------------------------------------------------------------- A-25 column summary
@register("column_summary", sql=b.with_ctes(b.SQL_OBS) + """
SELECT taxon, sum(value) AS total, min(value) AS min, max(value) AS max,
       round(avg(value), 6) + 0.0 AS mean, count(*) AS n, round(quantile_cont(value, 0.25), 6) + 0.0 AS q1,
       round(quantile_cont(value, 0.5), 6) + 0.0 AS median, round(quantile_cont(value, 0.75), 6) + 0.0 AS q3
FROM obs GROUP BY taxon
""")
def column_summary(spark, sf_dir):
    s = rs.column_summary(b.obs(spark, sf_dir), "taxon", "value")
    return s.withColumns({c: r6(c) for c in ("mean", "q1", "median", "q3")})
