"""Change-log-aware absence matrix (V-05 / R-1), the signature operator.

A taxon that entered the identification scheme on ``start_date`` cannot have
been recorded in samples taken before that date: such cells are "not looked
for" (sentinel -999), cells after the start with no record are true absences
(0), and a sample taken exactly on the start date with no record stays null.

Long output holds the (sample, label) cells that have a record.  A cell without
one needs no row: it is a function of the sample's date and the label's first
start (``label_starts``), so the wide sink (``absence_wide``) writes it by an
expression per column.  No sample x label product is made anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagic.functions.nulls import first_word, sum0
from pelagic.session import dealt, stored

SENTINEL = -999.0


def changelog_taxa(log: DataFrame, taxon: str = "taxon", parent: str = "parent",
                   level: str = "genus") -> DataFrame:
    """(a) change-log rows whose identity changed at ``level``.

    ``level="genus"``: first words of taxon and parent differ; ``"name"``:
    whole names differ.  A null parent is not a change (R drops NA there).
    """
    if level == "genus":
        cond = first_word(taxon) != first_word(parent)
    elif level == "name":
        cond = F.col(taxon) != F.col(parent)
    else:
        raise ValueError("level must be 'genus' or 'name'")
    return log.where(F.coalesce(cond, F.lit(False)))


def _records(obs: DataFrame, log: DataFrame, key: str, taxon: str, label: str, value: str, start: str, parent: str,
             level: str, log_taxon: str) -> DataFrame:
    """The labelled records (key, label, start, value); the start is null for taxa the log does not change."""
    aff = changelog_taxa(log, log_taxon, parent, level).select(
        F.col(log_taxon).alias("__taxon"), F.col(start).cast("timestamp_ntz").alias("__start"))
    # The change log is a small curated dimension; AQE broadcasts it when its
    # runtime size allows, else this is a shuffle join.
    o = obs.join(aff, obs[taxon] == aff["__taxon"], "left")
    return o.where(F.col(label).isNotNull() & (F.col(label) != "")).select(key, label, "__start", value)


def _sums(records: DataFrame, rows: int, key: str, label: str, value: str) -> DataFrame:
    """Sums per (key, label, start), dealt by ``key``.

    No hash table spans a file split: records are dealt to tasks of bounded rows
    before anything is summed, first by value too, so that a hot sample is spread.
    """
    groups = [key, label, "__start"]
    part = dealt(records, rows, *groups, value).groupBy(*groups, value).agg(F.sum(value).alias("__v"))
    return dealt(part.select(*groups, "__v"), rows, key).groupBy(*groups).agg(sum0("__v").alias("__v"))


def _firsts(records: DataFrame, key: str, label: str) -> DataFrame:
    """First start date per affected label: the one of the lowest (sample, start) record (W-05), null samples last."""
    per = records.where(F.col("__start").isNotNull()).groupBy(label, "__start").agg(F.min(key).alias("__k"))
    return per.groupBy(label).agg(F.min_by("__start", F.struct(F.col("__k").isNull(), "__k", "__start")).alias("__first"))


def label_starts(obs: DataFrame, log: DataFrame, key: str = "sample", taxon: str = "taxon", label: str = "genus",
                 value: str = "value", start: str = "start_date", parent: str = "parent", level: str = "genus",
                 log_taxon: str = "taxon") -> DataFrame:
    """(label, first_start) of the labels the change log affects: one row per label, at most one per log entry."""
    records = _records(obs, log, key, taxon, label, value, start, parent, level, log_taxon)
    return _firsts(records, key, label).withColumnRenamed("__first", "first_start")


def absence_matrix(samples: DataFrame, obs: DataFrame, log: DataFrame, key: str = "sample",
                   date: str = "sample_date", taxon: str = "taxon", label: str = "genus",
                   value: str = "value", start: str = "start_date", parent: str = "parent",
                   level: str = "genus", sentinel: float = SENTINEL, log_taxon: str = "taxon",
                   observed_flag: bool = False) -> DataFrame:
    """R-1 in long form, cells with a record: columns (key, label, value[, observed_flag]).

    ``obs`` rows must already carry the matrix ``label`` (genus, or the
    ``Genus species`` label) and be filtered for the level (blank labels
    removed).  Rows of change-log taxa take the start date of their taxon;
    per (sample, label) the source rules are:

    * unaffected rows: sum ignoring nulls;
    * affected rows: per start date, the sum (or ``sentinel`` when the
      sample predates the start) added up;
    * a sample with no affected record of an affected label: ``sentinel`` before the
      label's first start date, 0 after, null on the same date;
    * both kinds present: larger value, null if either is null (A-05).

    The sentinel stays in the value, as in the source, where it takes part
    in later strict sums and maxima (N-22).  ``observed_flag=True`` adds a
    boolean column: false when a sentinel entered the value (the value is
    the sentinel, or a per-start sum that includes it), true when the value
    comes from records and true absences only, null when the value is null.

    The facts are read once and their labelled records stored; sums and samples
    are dealt by ``key`` to partitions of bounded rows.
    """
    records = stored(_records(obs, log, key, taxon, label, value, start, parent, level, log_taxon), "absence-records", plain=True)
    rows = max(records.count(), samples.count())  # samples may outnumber the records
    firsts = stored(_firsts(records, key, label), "absence-firsts")
    return _cells(dealt(samples.select(key, date), rows, key), _sums(records, rows, key, label, value), firsts,
                  key, date, label, value, sentinel, observed_flag)


def _cells(samples: DataFrame, sums: DataFrame, firsts: DataFrame, key: str, date: str, label: str, value: str, sentinel: float,
           observed_flag: bool = False) -> DataFrame:
    """The matrix cells that have a record, from the sums per (key, label, start); both sides are dealt by ``key``."""
    s = samples.select(F.col(key), F.col(date).cast("timestamp_ntz").alias("__date"))
    from_log = F.col("__start").isNotNull()
    early = F.col("__start") > F.col("__date")
    cells = (sums.join(s, key, "inner").groupBy(key, label).agg(
        F.max("__date").alias("__date"),
        F.count_if(~from_log).alias("__nb"), F.max(F.when(~from_log, F.col("__v").cast("double"))).alias("__vb"),
        F.count_if(from_log).alias("__nc"), F.count_if(from_log & early).alias("__nc_s"),
        F.sum(F.when(from_log, F.when(early, F.lit(sentinel)).otherwise(F.col("__v").cast("double")))).alias("__vc"))
        .join(firsts, label, "left"))
    first, when = F.col("__first"), F.col("__date")
    blank = F.when(first > when, F.lit(sentinel)).when(first < when, F.lit(0.0))
    aff_val = F.when(F.col("__nc") > 0, F.col("__vc")).otherwise(blank)
    aff_present = (F.col("__nc") > 0) | first.isNotNull()
    result = (F.when(aff_present & (F.col("__nb") > 0),
                     F.when(aff_val.isNull(), F.lit(None)).otherwise(F.greatest(F.col("__vb"), aff_val)))
              .when(aff_present, aff_val)
              .otherwise(F.col("__vb")))
    cols = [key, label, result.cast("double").alias(value)]
    if observed_flag:
        tainted = F.when(F.col("__nc") > 0, F.col("__nc_s") > 0).otherwise(F.coalesce(blank == sentinel, F.lit(False)))
        from_b = ~aff_present | ((F.col("__nb") > 0) & (F.col("__vb") >= aff_val))
        cols.append(F.when(result.isNotNull(), ~(~from_b & tainted)).alias("observed_flag"))
    return cells.select(*cols)


def absence_wide(samples: DataFrame, obs: DataFrame, log: DataFrame, key: str = "sample", date: str = "sample_date",
                 taxon: str = "taxon", label: str = "genus", value: str = "value", start: str = "start_date", parent: str = "parent",
                 level: str = "genus", sentinel: float = SENTINEL, labels: list | None = None, log_taxon: str = "taxon",
                 attributes: tuple[str, ...] = ()) -> DataFrame:
    """R-1, the source's wide matrix: every sample, its attributes, one column per label.

    A cell with a record takes its value from :func:`absence_matrix`; one
    without is ``sentinel`` before the label's first start, null on that date,
    and 0 otherwise.  ``labels`` are the columns (all labels found, if None).

    The facts are read once: the labelled records are stored, one job over them finds
    the first starts, one the labels (the schema of the matrix), another makes the cells.
    Sums and samples are dealt by ``key`` to partitions of bounded rows.
    """
    records = stored(_records(obs, log, key, taxon, label, value, start, parent, level, log_taxon), "absence-records", plain=True)
    rows = max(records.count(), samples.count())  # samples may outnumber the records
    sums, samples = _sums(records, rows, key, label, value), dealt(samples.select(key, date, *attributes), rows, key)
    firsts = stored(_firsts(records, key, label), "absence-firsts")
    starts = {r[0]: r["__first"] for r in firsts.collect()}  # one row per label
    if labels is None:
        labels = sorted(r[0] for r in sums.join(samples.select(key), key, "left_semi").select(label).distinct().collect())
    cells = _cells(samples, sums, firsts, key, date, label, value, sentinel)
    per_key = cells.where(F.col(label).isin(labels)).groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct(label, value))).alias("__m"))  # at most one entry per label
    out = [F.col(key), *[F.col(a) for a in attributes]]
    when = F.col(date).cast("timestamp_ntz")
    for x in labels:
        blank = F.lit(0.0)
        if x in starts:
            first = F.lit(str(starts[x])).cast("timestamp_ntz")
            blank = F.when(first > when, F.lit(sentinel)).when(first < when, F.lit(0.0))
        has = F.coalesce(F.map_contains_key("__m", F.lit(x)), F.lit(False))
        out.append(F.when(has, F.element_at("__m", F.lit(x))).otherwise(blank).alias(str(x)))
    return samples.join(per_key, key, "left").select(*out)
