"""Readers and writers: driver tables and derived views, CSV/delimited/text, GeoJSON, Parquet, profiles."""

from metrolens.sources.clustered import file_ranges, read_range, write_clustered
from metrolens.sources.delimited import (
    column_at,
    normalize_column_names,
    number_lines,
    read_csv,
    read_delimited,
    read_text,
    sample_lines,
    sample_rows,
    split_fields,
    trim_header_names,
    write_csv,
    write_text,
)
from metrolens.sources.geojson import (
    feature_points,
    parse_geojson,
    profile_geojson,
    read_features,
    read_geojson,
    write_geojson,
)
from metrolens.sources.profile import profile
from metrolens.sources.tables import TABLES, blocks, incidents, income, orders_text, read_table, sites

__all__ = [
    "column_at", "normalize_column_names", "number_lines", "read_csv", "read_delimited", "read_text", "sample_lines", "sample_rows", "split_fields", "trim_header_names",
    "write_csv", "write_text",
    "file_ranges", "read_range", "write_clustered",
    "feature_points", "parse_geojson", "profile_geojson", "read_features", "read_geojson", "write_geojson",
    "profile",
    "TABLES", "blocks", "incidents", "income", "orders_text", "read_table", "sites",
]
