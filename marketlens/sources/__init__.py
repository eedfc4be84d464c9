"""Sources and sinks (S-*) and the marketplace stand-in views."""

from marketlens.sources import standins  # noqa: F401
from marketlens.sources.tables import (  # noqa: F401
    SCHEMAS, Tables, evolve_table, export_bundle, load_or_build, load_tables, missing_keys,
    read_csv, read_query, read_table, table_exists, write_csv, write_table,
)
