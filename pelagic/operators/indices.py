"""Ecological indices per sample (A-07..A-13, A-19, R-4, A-28).

All indices are plain two-level aggregates keyed by the sample; nothing is
pivoted before computing (the source pivots to a wide matrix to call a matrix
routine, then glues results back by row position).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagic.functions.labels import genus_species
from pelagic.functions.nulls import matches, safe_div, strict_sum, sum0

# Species-level exclusion patterns of the source (regex, so the
# dot in "cf." matches any character, N-10) and the excluded species token.
# The indices keep complexes ("a/b", binned to their first word); the species
# matrices drop them.
INDEX_DROP_PATTERNS = ("cf.", "grp")
MATRIX_DROP_PATTERNS = ("cf.", "/", "grp")
SPECIES_UNRESOLVED = "spp."

# Cell carbon C = a * V^b per taxon group (pg per cell), with a
# constant for cyanobacteria and a default for every other group.
CELL_CARBON_COEFFS = {
    "Dinoflagellate": (0.76, 0.819),
    "Ciliate": (0.22, 0.939),
}
CELL_CARBON_CONSTANT = {"Cyanobacteria": 0.2}
CELL_CARBON_DEFAULT = (0.288, 0.811)


def species_filter(df: DataFrame, genus: str, species: str, drop: Sequence[str], label: str = "TaxonName",
                   bin_complex: bool = True,
                   include_genus_level: bool = False) -> DataFrame:
    """R-4: keep resolved species and add a ``Genus species`` label.

    Drops null species, ``spp.``, and species matching any of ``drop`` (regex);
    with ``bin_complex`` only the first word of the species is kept (complexes
    binned).  Null comparisons drop the row, as in the source filter.

    ``include_genus_level=True`` also keeps the genus-level ``spp.`` rows
    (label ``Genus spp.``), which the source means to add to its species
    matrices but filters away (D-25); off by default, as executed.
    """
    cond = species_condition(species, drop, include_genus_level)
    return df.where(cond).withColumn(label, genus_species(genus, species, bin_complex))


def species_condition(species: str, drop: Sequence[str],
                      include_genus_level: bool = False) -> Column:
    """The row condition of :func:`species_filter` as a Column (null counts as false)."""
    cond = F.col(species).isNotNull()
    if not include_genus_level:
        cond = cond & (F.col(species) != F.lit(SPECIES_UNRESOLVED))
    for p in drop:
        cond = cond & ~matches(species, p)
    return F.coalesce(cond, F.lit(False))


def taxon_sums(df: DataFrame, key: str | Sequence[str], taxon: str, value: str, out: str = "x") -> DataFrame:
    """Sum of ``value`` per (key, taxon) ignoring nulls (A-01).  Partial aggregation happens map-side."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys, taxon).agg(sum0(value).alias(out))


def shannon(df: DataFrame, key: str | Sequence[str], taxon: str, value: str,
            out: str = "shannon") -> DataFrame:
    """A-11: H = -sum p ln p over per-taxon sums, p = x / T.

    Written as ``ln T - sum(x ln x) / T`` so one pass over the (key, taxon)
    sums suffices and single-taxon samples give +0.0.  Taxa with x = 0
    contribute nothing; a sample whose total is 0 gets H = 0 (as the source's
    matrix routine does).
    """
    keys = [key] if isinstance(key, str) else list(key)
    x = taxon_sums(df, keys, taxon, value)
    xlnx = F.when(F.col("x") > 0, F.col("x") * F.ln(F.col("x"))).otherwise(F.lit(0.0))
    agg = x.groupBy(*keys).agg(F.sum("x").alias("__t"), F.sum(xlnx).alias("__s"))
    h = F.when(F.col("__t") > 0, F.ln(F.col("__t")) - F.col("__s") / F.col("__t")).otherwise(F.lit(0.0))
    return agg.select(*keys, (h + F.lit(0.0)).alias(out))


def richness(df: DataFrame, key: str | Sequence[str], taxon: str, distinct: bool = False,
             out: str = "n_species") -> DataFrame:
    """A-12: taxon records per sample (rows, as in the source; ``distinct=True`` counts taxa, D-21)."""
    keys = [key] if isinstance(key, str) else list(key)
    n = F.countDistinct(taxon) if distinct else F.count(F.lit(1))
    return df.groupBy(*keys).agg(n.alias(out))


def diversity(df: DataFrame, key: str | Sequence[str], taxon: str, value: str, distinct: bool = False,
              prefix: str = "") -> DataFrame:
    """A-11 + A-12 + A-13 in one pass: n, H and evenness H / ln n (n = 1 -> null).

    Both the record count and the per-taxon sums come from one
    ``groupBy(key, taxon)`` followed by one ``groupBy(key)``: a single shuffle
    on the sample key for the taxon sums and a second, tiny one per sample.
    """
    keys = [key] if isinstance(key, str) else list(key)
    per_taxon = df.groupBy(*keys, taxon).agg(sum0(value).alias("x"), F.count(F.lit(1)).alias("__rows"))
    n = F.count(F.lit(1)) if distinct else F.sum("__rows")
    agg = per_taxon.groupBy(*keys).agg(n.alias("__n"), *diversity_sums("x"))
    return agg.select(*keys, *diversity_columns(prefix))


def diversity_sums(x: str, include: Column | None = None, suffix: str = "") -> list[Column]:
    """Second-level aggregates of A-11/A-13 over per-taxon sums ``x``: total ``__t`` and
    ``__s`` = sum of x ln x (only rows where ``include`` holds, when given)."""
    xc = F.col(x)
    xlnx = F.when(xc > 0, xc * F.ln(xc)).otherwise(F.lit(0.0))
    if include is not None:
        xc, xlnx = F.when(include, xc), F.when(include, xlnx)
    return [F.sum(xc).alias(f"__t{suffix}"), F.sum(xlnx).alias(f"__s{suffix}")]


def diversity_columns(prefix: str = "", present: Column | None = None, suffix: str = "") -> list[Column]:
    """n, H = ln T - S / T (+0.0; T = 0 gives 0) and evenness H / ln n from ``__n``, ``__t``, ``__s`` (with
    ``suffix``); all null where ``present`` is false."""
    n, t, s = (F.col(f"__{c}{suffix}") for c in "nts")
    h = F.when(t > 0, F.ln(t) - s / t).otherwise(F.lit(0.0)) + F.lit(0.0)
    cols = {"n_species": n.cast("long"), "shannon": h, "evenness": safe_div(h, F.ln(n.cast("double")))}
    return [(F.when(present, c) if present is not None else c).alias(f"{prefix}{k}") for k, c in cols.items()]


def ratio_of_sums(df: DataFrame, key: str | Sequence[str], num: Column, den: Column, out: str) -> DataFrame:
    """A-07: sum(num) / sum(den) per key, nulls ignored, 0 denominator -> null."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(safe_div(F.sum(num), F.sum(den)).alias(out))


def mean_cell_volume(df: DataFrame, key: str | Sequence[str], cells: str, biovolume: str,
                     out: str = "AvgCellVol_um3") -> DataFrame:
    """A-08: rows with null biovolume removed, then strict sum(biovolume) / strict sum(cells)."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.where(F.col(biovolume).isNotNull()).groupBy(*keys)
            .agg(safe_div(strict_sum(biovolume), strict_sum(cells)).alias(out)))


def class_share(df: DataFrame, key: str | Sequence[str], cls: str | Column, value: str, a: str, b: str,
                out: str) -> DataFrame:
    """A-09: share of class ``a`` in a + b per key; a missing class gives null.

    Equivalent of pivoting the two class sums and computing a / (a + b)
    without a pivot: conditional sums keep null when a class has no row.
    """
    keys = [key] if isinstance(key, str) else list(key)
    c = F.col(cls) if isinstance(cls, str) else cls
    has_a = F.max(F.when(c == a, F.lit(1)))
    has_b = F.max(F.when(c == b, F.lit(1)))
    sa = F.when(has_a.isNotNull(), sum0(F.when(c == a, F.col(value))))
    sb = F.when(has_b.isNotNull(), sum0(F.when(c == b, F.col(value))))
    return (df.where(c.isin(a, b)).groupBy(*keys)
            .agg(safe_div(sa, sa + sb).alias(out)))


def cell_carbon_expr(group: str | Column, cells: str | Column, biovolume: str | Column,
                     coeffs: Mapping[str, tuple[float, float]] = CELL_CARBON_COEFFS,
                     constants: Mapping[str, float] = CELL_CARBON_CONSTANT,
                     default: tuple[float, float] = CELL_CARBON_DEFAULT) -> Column:
    """A-10 per row: carbon per litre = cells * C(group, V), V = biovolume / cells (F-22)."""
    g = F.col(group) if isinstance(group, str) else group
    n = F.col(cells) if isinstance(cells, str) else cells
    bv = F.col(biovolume) if isinstance(biovolume, str) else biovolume
    v = safe_div(bv, n)
    expr = None
    for name, (a, b) in coeffs.items():
        term = F.lit(a) * F.pow(v, F.lit(b))
        expr = F.when(g == name, term) if expr is None else expr.when(g == name, term)
    for name, k in constants.items():
        expr = F.when(g == name, F.lit(k)) if expr is None else expr.when(g == name, F.lit(k))
    expr = expr.otherwise(F.lit(default[0]) * F.pow(v, F.lit(default[1])))
    return n * expr


def cell_carbon(df: DataFrame, key: str | Sequence[str], group: str, cells: str, biovolume: str,
                out: str = "PhytoBiomassCarbon_pg_L", **kw) -> DataFrame:
    """A-10: strict sum of per-row carbon (one null row makes the sample null, A-04)."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.withColumn("__carbon", cell_carbon_expr(group, cells, biovolume, **kw))
            .groupBy(*keys).agg(strict_sum("__carbon").alias(out)))


def group_totals(samples: DataFrame, obs: DataFrame, key: str, group: str, value: str,
                 exclude: Sequence[str] = (), placeholder: str | None = None,
                 sample_cols: Sequence[str] = ()) -> DataFrame:
    """R-3 / A-19: per-sample totals by higher group with an exclusion list, long form.

    Groups are summed per (sample, group) ignoring nulls, excluded groups
    removed (null groups are dropped by the filter), then attached to every
    sample by a left join.  A sample with no group row gets ``placeholder``
    with 0 when given (V-04), else a null group with 0.
    """
    g = (obs.groupBy(key, group).agg(sum0(value).alias(value))
         .where(F.col(group).isNotNull() & ~F.col(group).isin(list(exclude))))
    s = samples.select(key, *sample_cols)
    out = s.join(g, key, "left")
    fill = F.lit(placeholder) if placeholder is not None else F.lit(None).cast("string")
    return out.select(key, *sample_cols, F.coalesce(F.col(group), fill).alias(group),
                      F.coalesce(F.col(value), F.lit(0.0)).alias(value))


def relabel_resum(df: DataFrame, key: str, genus: str, species: str, value: str,
                  label: str = "TaxonName") -> DataFrame:
    """A-28: sex / stage rows relabelled to ``Genus species`` (first species word) and re-summed."""
    lab = genus_species(genus, species, bin_complex=True)
    return (df.where(F.col(species).isNotNull() & F.col(genus).isNotNull())
            .withColumn(label, lab).groupBy(key, label).agg(sum0(value).alias(value)))
