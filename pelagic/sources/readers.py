"""Typed scans of the delimited / gridded / vertex sources (S-01..S-24).

Every source has an explicit schema and its own null token (no inference),
renames are applied right after the scan, and row filters are plain
``where`` clauses that Catalyst pushes into the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pelagic.functions.nulls import nan_to_null


@dataclass(frozen=True)
class SourceSpec:
    """How to read one delimited source: schema (DDL), null token, renames, row filter."""

    schema: str
    null_value: str = ""
    renames: Mapping[str, str] = field(default_factory=dict)
    where: str | None = None
    header: bool = True
    skip_lines: int = 0


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: str | StructType,
                   null_value: str = "", header: bool = True, renames: Mapping[str, str] | None = None,
                   where: str | Column | None = None, timestamp_format: str | None = None) -> DataFrame:
    """S-01 / S-02 / S-04 / S-05: typed CSV scan with a per-source null token, renames, row filter.

    With a header, columns are matched to the schema *by name* (file column
    order does not matter, extra columns are skipped as with ``col_skip``);
    text is cast with try-semantics so malformed numbers become null instead
    of failing the job (N-14).
    """
    r = spark.read.option("header", header).option("nullValue", null_value).option("mode", "PERMISSIVE")
    raw = r.csv(list(path) if not isinstance(path, str) else path)
    df = _typed(spark, raw, schema, header, timestamp_format)
    if renames:
        df = df.withColumnsRenamed(dict(renames))
    if where is not None:
        df = df.where(where)
    return df


def _struct(spark: SparkSession, schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema


def _typed(spark: SparkSession, raw: DataFrame, schema: str | StructType, by_name: bool,
           timestamp_format: str | None = None) -> DataFrame:
    st = _struct(spark, schema)
    cols = []
    for i, f in enumerate(st.fields):
        src = F.col(f"`{f.name}`") if by_name else F.col(raw.columns[i])
        t = f.dataType.simpleString()
        if timestamp_format and t.startswith("timestamp"):
            v = F.try_to_timestamp(src, F.lit(timestamp_format)).cast(t)
        else:
            v = src.try_cast(t)
        cols.append(v.alias(f.name))
    return raw.select(*cols)


def read_with_preamble(spark: SparkSession, path: str, skip: int, schema: str | StructType,
                       null_value: str = "", renames: Mapping[str, str] | None = None) -> DataFrame:
    """S-03: delimited files that start with a free-text preamble of ``skip`` lines.

    ``path`` may be a folder of exports, each with its own preamble and column
    order.  Lines are scanned as text; a file's header is its first line that
    names every column of the schema, and its data lines are those with as many
    fields as the header, but the header itself.  All of it runs in the JVM.
    ``skip`` documents the layout; a preamble of another length reads the same.
    """
    names = _struct(spark, schema).fieldNames()
    lines = spark.read.text(path).select(F.col("value").alias("__line"), F.col("_metadata.file_path").alias("__file"))
    fields = F.split("__line", ",", -1)
    bare = F.transform(fields, lambda x: F.trim(F.regexp_replace(x, '"', "")))
    is_header = F.lit(True)
    for n in names:
        is_header = is_header & F.array_contains(bare, n)
    heads = (lines.where(is_header).groupBy("__file").agg(F.min("__line").alias("__head")))  # one row per file
    layouts = [r[0] for r in heads.select("__head").distinct().collect()]  # one per export format
    out = None
    for head in layouts:
        cols = [c.strip().strip('"') for c in head.split(",")]
        st = ", ".join(f"`{c}` string" for c in cols)
        own = lines.join(heads.where(F.col("__head") == head), "__file").where(F.col("__line") != head)
        own = own.select(F.from_csv("__line", F.lit(st), {"nullValue": null_value, "mode": "PERMISSIVE"}).alias("r"),
                         F.size(F.split("__line", ',(?=(?:[^"]*"[^"]*")*[^"]*$)', -1)).alias("__n"))
        part = _typed(spark, own.where(F.col("__n") == len(cols)).select("r.*"), schema, True)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], _struct(spark, schema))
    return out.withColumnsRenamed(dict(renames)) if renames else out


def read_source(spark: SparkSession, path: str, spec: SourceSpec) -> DataFrame:
    """Read a source described by a :class:`SourceSpec`."""
    if spec.skip_lines:
        df = read_with_preamble(spark, path, spec.skip_lines, spec.schema, spec.null_value, spec.renames)
        return df.where(spec.where) if spec.where else df
    return read_delimited(spark, path, spec.schema, spec.null_value, spec.header, spec.renames, spec.where)


# Schemas and null tokens of the source tables present in the
# reference checkout (FIXTURES.md "Present"), with product column names.
# S-07 station reference table: NRS rows only; the depth column is read by the
# file's own name STATIONDEPTH_M (D-15).
STATIONS = SourceSpec(
    schema=("PROJECTNAME string, STATIONCODE string, STATIONNAME string, NODE string, STATECODE string, "
            "LONGITUDE double, LATITUDE double, STATIONSTARTDATE timestamp_ntz, STATIONDEPTH_M double, "
            "SAMPLINGEFFORT string, IMCRA string, IMCRA_PB string, MANAGEMENTREGION string"),
    null_value="",
    renames={"STATIONNAME": "Station", "LONGITUDE": "Longitude", "LATITUDE": "Latitude",
             "STATIONDEPTH_M": "StationDepth_m"},
    where="PROJECTNAME = 'NRS'",
)
# S-12 change-log loaders (phytoplankton and zooplankton logs share this layout).
ZOOP_CHANGELOG = SourceSpec(
    schema="TAXON_NAME string, START_DATE timestamp_ntz, PARENT_NAME string",
    renames={"TAXON_NAME": "TaxonName", "START_DATE": "StartDate", "PARENT_NAME": "ParentName"},
)
# S-19 satellite property side table, null token "(null)".
SATELLITE_VALUES = SourceSpec(
    schema="SAMPLE long, SST double, CHLA double, DEPTH_M double",
    null_value="(null)",
    renames={"SAMPLE": "Sample", "DEPTH_M": "Depth_m"},
)


def recorder_trips(df: DataFrame, sample_type: str = "SAMPLETYPE", letter: str | None = None) -> DataFrame:
    """S-09: towed-recorder samples with a sample type; optionally only types containing ``letter``."""
    out = df.where(F.col(sample_type).isNotNull())
    return out.where(F.col(sample_type).contains(letter)) if letter else out


def read_grid(spark: SparkSession, path: str, products: Sequence[str] | None = None,
              periods: Sequence[str] | DataFrame | None = None, resolution: str | None = None,
              schema: str | None = None) -> DataFrame:
    """S-20: long grid table stored as parquet partitioned by (product, resolution, period).

    Filters on the partition columns prune whole directories; lat/lon range
    filters use the row-group statistics of the cell-clustered files.  ``periods``
    may be a frame with a column ``period`` (see :func:`asked_periods`): the layers
    to read are then found at run time, by dynamic partition pruning.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    # a period such as 2010 is a directory name, not a number
    df = df.withColumns({c: F.col(c).cast("string") for c in ("product", "resolution", "period") if c in df.columns and dict(df.dtypes)[c] != "string"})
    if products is not None:
        df = df.where(F.col("product").isin(list(products)))
    if resolution is not None:
        df = df.where(F.col("resolution") == resolution)
    if isinstance(periods, DataFrame):
        # at most one row per calendar period: a few million at the finest resolution
        df = df.join(F.broadcast(periods.select("period")), "period", "left_semi")
    elif periods is not None:
        df = df.where(F.col("period").isin(list(periods)))
    return df


def asked_periods(points: DataFrame, period: Column) -> DataFrame:
    """The distinct periods that points ask for, as the filter of :func:`read_grid`."""
    return points.select(period.alias("period")).where(F.col("period") > "").distinct()


def read_registry(spark: SparkSession, registry: DataFrame, station: str = "station", path: str = "path",
                  fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """S-24: every source listed in a (station, path) registry in one scan, station as a column.

    The registry is a list of sources (one row each); a path is a file or a
    folder, with all files below it.  All paths are read together (parquet schemas are merged by name; a
    text source needs ``schema``).  A row's station is found by its file's path:
    the leading segments, cut to each length that a registered path has, meet the
    registry in a hash join on the small side.  A file below two registered paths
    belongs to both.
    """
    listed = [(r[0], *_qualified(spark, r[1])) for r in registry.select(station, path).distinct().collect()]
    if not listed:
        raise ValueError("the registry lists no source")
    roots = {uri: plain for _, uri, plain in listed}
    top = [plain for uri, plain in sorted(roots.items()) if not any(uri[:k] in roots for k in range(len(uri)) if uri[k] == "/")]
    reader = spark.read.format(fmt).option("header", True).option("recursiveFileLookup", True)
    if schema:
        reader = reader.schema(schema)
    elif fmt == "parquet":
        reader = reader.option("mergeSchema", True)
    df = reader.load(top)
    lengths = sorted({p.count("/") + 1 for p in roots})
    segments = F.split(F.regexp_replace("_metadata.file_path", "^file:/+", "file:/"), "/")
    heads = F.array(*[F.array_join(F.slice(segments, 1, n), "/") for n in lengths])
    own = [c for c in df.columns if c != station]
    rows = df.select(*[F.col(f"`{c}`") for c in own], F.explode(F.array_distinct(heads)).alias("__head"))
    known = spark.createDataFrame([(uri, name) for name, uri, _ in listed], f"__head string, `{station}` string")
    return rows.join(F.broadcast(known), "__head").drop("__head")  # one row per source, already on the driver


def _qualified(spark: SparkSession, path: str) -> tuple[str, str]:
    """A path as the file source reports it (with its scheme, encoded, no closing slash), and as it is read."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    p = p.makeQualified(fs.getUri(), fs.getWorkingDirectory())
    return p.toUri().toString().replace("file:///", "file:/").rstrip("/"), p.toString()


def read_vertices(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S-23: polygon layer as a vertex table (polygon_id, ring_id, vertex_no, x, y, attributes...).

    A text source gets the vertex table's types: numbers for the keys and
    coordinates (a malformed one is null), text for layer and attributes.
    """
    df = spark.read.format(fmt).option("header", True).option("inferSchema", False).load(path)
    typed = {"polygon_id": "long", "ring_id": "int", "vertex_no": "long", "x": "double", "y": "double"}
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in typed.items() if c in df.columns and df.schema[c].dataType.simpleString() == "string"})


__all__ = ["SourceSpec", "read_delimited", "read_with_preamble", "read_source", "STATIONS", "ZOOP_CHANGELOG",
           "SATELLITE_VALUES", "recorder_trips", "read_grid", "asked_periods", "read_registry", "read_vertices", "nan_to_null"]
