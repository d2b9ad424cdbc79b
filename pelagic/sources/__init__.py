"""Typed sources and product sinks."""

from pelagic.sources.readers import (  # noqa: F401
    SATELLITE_VALUES, STATIONS, ZOOP_CHANGELOG, SourceSpec, read_delimited, read_grid, read_registry,
    read_source, read_vertices, read_with_preamble, recorder_trips,
)
from pelagic.sources.sinks import prepare_product, write_grid, write_product  # noqa: F401
