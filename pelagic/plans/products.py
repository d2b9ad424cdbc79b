"""Composite products (R-5..R-8 style): named input DataFrames in, one product DataFrame out.

Each product is a set of per-sample aggregates combined by key joins on the
sample (the source glues results by row position).  Aggregates that share a
source run as one conditional-aggregation pass, so a fact table is scanned
once per shape of grouping, and every partial result is hash-partitioned by
the sample key for the joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagic.functions.labels import genus_species, sample_code
from pelagic.functions.nulls import safe_div, sum0
from pelagic.operators import indices as ix

# Taxon groups used by the station indices.
COPEPOD = "COPEPOD"
DIET_CARNIVORE = "CC"
DIATOM_GROUPS = ("Centric diatom", "Pennate diatom")
DINOFLAGELLATE = "Dinoflagellate"
OTHER_GROUP = "Other"


def water_quality(trips: DataFrame, sources: Sequence[tuple[DataFrame, Sequence[str]]], trip: str = "trip",
                  depth: str = "depth", attributes: Sequence[str] = (),
                  attached: Sequence[tuple[DataFrame, Sequence[str]]] = ()) -> DataFrame:
    """R-5: replicate means of every source per (trip, depth), with the trip's attributes and the sample code.

    ``sources``: (frame, value columns) pairs, each frame with the key columns.
    The sources are stacked and averaged per key, each into its own columns: the key
    spine is the group key and each source is scanned once.  A key found in any source is kept, also without a trip row; a key that
    only ``attached`` sources (cast means) have is not.
    """
    every = [*sources, *attached]
    slots = [f"__{k}" for k in range(max(len(values) for _, values in every))]
    stacked = None
    for k, (frame, values) in enumerate(every):
        own = [F.col(v).cast("double") for v in values] + [F.lit(None).cast("double")] * (len(slots) - len(values))
        part = frame.select(trip, depth, F.lit(k).alias("__source"), *[c.alias(n) for c, n in zip(own, slots)])
        stacked = part if stacked is None else stacked.unionByName(part)
    # one shuffle: a key's sources meet map-side, its means need no second grouping
    means = [F.avg(F.when(F.col("__source") == k, F.col(slots[j]))).alias(v) for k, (_, values) in enumerate(every) for j, v in enumerate(values)]
    columns = [v for _, values in every for v in values]
    means = stacked.groupBy(trip, depth).agg(F.min("__source").alias("__first"), *means).where(F.col("__first") < len(sources))
    out = means.join(trips.select(trip, *attributes), trip, "left") if attributes else means
    return out.select(trip, depth, sample_code("NRS", trip, depth).alias("sample_code"), *attributes, *columns)


# Columns of one stacked observation row; a source fills those it has.
OBSERVATION = ("zoo boolean, counted boolean, phyto boolean, taxon string, genus string, species string, copepod string, "
               "abund double, count double, group string, cells double, biovolume double")
PLANKTON = ("ZoopAbundance", "CopeAbundance", "AvgTotalLengthCopepod", "HerbivoreCarnivoreCopepodRatio", "cope_n_species", "cope_shannon",
            "cope_evenness", "PhytoBiomassCarbon", "AbundancePhyto", "DiatomDinoflagellateRatio", "AvgCellVol",
            *[f"{p}_{c}" for p in ("phyto", "diatom", "dino") for c in ("n_species", "shannon", "evenness")])


def stack_observations(key: str, zoo: DataFrame, phyto: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """The sources of a plankton product as one frame (see ``OBSERVATION``).

    ``zoo``: (key, taxon, genus, species, copepod, abund); ``phyto``: (key, genus,
    species, group, cells, biovolume); ``counts``: (key, genus, species, copepod,
    count), the records of the copepod diversity (S-11).  Without it the zooplankton
    records count, by their abundance.
    """
    z = zoo.withColumns({"zoo": F.lit(True), "counted": F.lit(counts is None), "count": F.col("abund")})
    parts = [z, phyto.withColumn("phyto", F.lit(True))]
    if counts is not None:
        parts.append(counts.withColumn("counted", F.lit(True)))
    names = [c.split() for c in OBSERVATION.split(", ")]
    out = None
    for part in parts:
        part = part.select(key, *[(F.col(n) if n in part.columns else F.lit(None)).cast(t).alias(n) for n, t in names])
        out = part if out is None else out.unionByName(part)
    return out


def plankton_indices(obs: DataFrame, traits: DataFrame, key: str = "sample") -> DataFrame:
    """The plankton columns of R-6 and R-7 (``PLANKTON``) per key, from stacked observations read once.

    ``traits``: (taxon, size, diet), one row per taxon.  One two-level aggregation:
    per (key, what the record counts for, taxon label), where map-side partial sums
    absorb a hot sample, then per key.
    """
    t = traits.select(F.col("taxon").alias("__tt"), F.col("size").alias("__size"), F.col("diet").alias("__diet"))
    o = obs.join(t, obs["taxon"] == t["__tt"], "left")

    def true(c: Column) -> Column:
        return F.coalesce(c, F.lit(False))

    grp, cells, bv = F.col("group"), F.col("cells"), F.col("biovolume")
    zoo, cope = true(F.col("zoo")), true(F.col("zoo") & (F.col("copepod") == COPEPOD))
    phyto = true(F.col("phyto") & (grp != OTHER_GROUP))
    species = ix.species_condition("species", ix.INDEX_DROP_PATTERNS)
    qc = true(F.col("counted") & (F.col("copepod") == COPEPOD)) & species
    qp = phyto & species
    traited = cope & F.col("__tt").isNotNull()
    diet = F.when(F.col("__diet") == DIET_CARNIVORE, F.lit("CC")).when(F.col("__diet").isNotNull(), F.lit("CO"))
    eats = traited & F.col("__diet").isNotNull() & F.col("abund").isNotNull()
    carbon = ix.cell_carbon_expr("group", "cells", "biovolume")
    diatom, dino = phyto & grp.isin(*DIATOM_GROUPS), phyto & (grp == DINOFLAGELLATE)

    def flag(c: Column) -> Column:
        return F.when(c, F.lit(1))

    # what each record adds, computed once per row; the aggregation only sums and takes maxima
    sums = {"__z": F.when(zoo, F.col("abund")), "__ca": F.when(cope, F.col("abund")),
            "__sn": F.when(traited, F.col("__size") * F.col("abund")), "__sa": F.when(traited, F.col("abund")),
            "__co": F.when(eats & (diet == "CO"), F.col("abund")), "__cc": F.when(eats & (diet == "CC"), F.col("abund")),
            "__xc": F.when(qc, F.col("count")), "__carbon": F.when(phyto, carbon), "__cells": F.when(phyto, cells),
            "__d": F.when(diatom, cells), "__dn": F.when(dino, cells), "__bv": F.when(phyto & bv.isNotNull(), bv),
            "__bc": F.when(phyto & bv.isNotNull(), cells), "__x": F.when(qp, cells), "__xd": F.when(qp & diatom, cells),
            "__xn": F.when(qp & dino, cells), "__rows": F.lit(1).cast("long"), "__rd": flag(diatom).cast("long"), "__rn": flag(dino).cast("long")}
    tops = {"__hc": flag(cope), "__h_co": flag(eats & (diet == "CO")), "__h_cc": flag(eats & (diet == "CC")), "__hp": flag(phyto),
            "__hd": flag(diatom), "__hn": flag(dino), "__c_null": flag(phyto & carbon.isNull()), "__cn": flag(phyto & bv.isNotNull() & cells.isNull())}
    label = F.when(qc | qp, genus_species("genus", "species"))
    row = o.select(key, qc.alias("__qc"), qp.alias("__qp"), label.alias("__tn"), *[c.alias(n) for n, c in {**sums, **tops}.items()])
    one = row.groupBy(key, "__qc", "__qp", "__tn").agg(*[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in tops])
    q_c, q_p = F.col("__qc"), F.col("__qp")
    q_d, q_n = q_p & (F.col("__rd") > 0), q_p & (F.col("__rn") > 0)
    per_taxon = one.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("__xc", "__x", "__xd", "__xn")})
    two = per_taxon.groupBy(key).agg(
        sum0("__z").alias("ZoopAbundance"), *[F.max(c).alias(c) for c in tops],
        *[F.sum(c).alias(c) for c in ("__sn", "__sa", "__carbon", "__bv", "__bc")],
        *[sum0(c).alias(c) for c in ("__ca", "__co", "__cc", "__cells", "__d", "__dn")],
        F.sum(F.when(q_c, F.col("__rows"))).alias("__n_c"), *ix.diversity_sums("__xc", q_c, "_c"),
        F.sum(F.when(q_p, F.col("__rows"))).alias("__n"), *ix.diversity_sums("__x", q_p),
        F.sum(F.when(q_d, F.col("__rd"))).alias("__n_d"), *ix.diversity_sums("__xd", q_d, "_d"),
        F.sum(F.when(q_n, F.col("__rn"))).alias("__n_n"), *ix.diversity_sums("__xn", q_n, "_n"))

    def where(has: str, c: Column) -> Column:
        return F.when(F.col(has).isNotNull(), c)

    co, cc = where("__h_co", F.col("__co")), where("__h_cc", F.col("__cc"))
    d, n = where("__hd", F.col("__d")), where("__hn", F.col("__dn"))
    return two.select(
        key, "ZoopAbundance", where("__hc", F.col("__ca")).alias("CopeAbundance"),
        safe_div(F.col("__sn"), F.col("__sa")).alias("AvgTotalLengthCopepod"),
        safe_div(co, co + cc).alias("HerbivoreCarnivoreCopepodRatio"), *ix.diversity_columns("cope_", F.col("__n_c") > 0, "_c"),
        F.when(F.col("__c_null").isNull(), F.col("__carbon")).alias("PhytoBiomassCarbon"),
        where("__hp", F.col("__cells")).alias("AbundancePhyto"), safe_div(d, d + n).alias("DiatomDinoflagellateRatio"),
        F.when(F.col("__cn").isNull(), safe_div(F.col("__bv"), F.col("__bc"))).alias("AvgCellVol"),
        *ix.diversity_columns("phyto_", F.col("__n") > 0), *ix.diversity_columns("diatom_", F.col("__n_d") > 0, "_d"),
        *ix.diversity_columns("dino_", F.col("__n_n") > 0, "_n"))


def indices_product(trips: DataFrame, plankton: DataFrame, key: str = "sample", attributes: Sequence[str] = ("biomass",),
                    parts: Sequence[DataFrame] = ()) -> DataFrame:
    """R-6 / R-7: every trip with its attributes, its plankton columns, and those of further per-trip ``parts``.

    A part has ``key`` and one row per trip (surface cast means, mixed layer,
    nutrient means, pigment; or the property table of a recorder sample).
    """
    out = trips.select(key, *attributes)
    for part in (plankton, *parts):
        out = out.join(part, key, "left")
    # trips with no zooplankton row at all still total 0 (sum over a left join)
    out = out.withColumn("ZoopAbundance", F.coalesce(F.col("ZoopAbundance"), F.lit(0.0)))
    return out.select(key, *attributes, *PLANKTON, *[c for p in parts for c in p.columns if c != key])


def station_indices(trips: DataFrame, zoo: DataFrame, phyto: DataFrame, traits: DataFrame,
                    key: str = "sample", water: Sequence[DataFrame] = (), counts: DataFrame | None = None,
                    attributes: Sequence[str] = ("biomass",)) -> DataFrame:
    """R-6 from separate sources (see :func:`stack_observations`): each is read once."""
    plankton = plankton_indices(stack_observations(key, zoo, phyto, counts), traits, key)
    return indices_product(trips, plankton, key, attributes, water)
