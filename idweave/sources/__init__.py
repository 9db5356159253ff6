"""Sources and sinks: table scans, cell layout, writers, upserts."""

from .cells import decode_cell_records, from_cells, lines_to_cells, to_cells  # noqa: F401
from .sinks import delete_keys, delete_where, upsert, write_partitions  # noqa: F401
from .tables import (  # noqa: F401
    after, day_prefix, import_table, read_csv, read_jdbc, read_json, read_partition, read_table, table_path,
    with_domain,
)
