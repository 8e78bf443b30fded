"""Sources and sinks."""

from ledgerline.sources.io import (  # noqa: F401
    LoadReport, Source, backup, evolve, overwrite_load, overwrite_where, read_csv,
    read_landing, read_mapping, read_schema, read_table, table_keys, write_all,
    write_partitions, write_rejects, write_table,
)
