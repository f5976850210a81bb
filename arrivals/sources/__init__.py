from arrivals.sources.readers import (
    read_delimited,
    read_inferred,
    read_lookup,
    read_parquet,
    read_table,
)
from arrivals.sources.sinks import (
    append_by_name,
    conform,
    refresh_months,
    replace_table,
    write_parquet,
)

__all__ = [
    "read_delimited", "read_inferred", "read_lookup", "read_parquet", "read_table",
    "append_by_name", "conform", "refresh_months", "replace_table", "write_parquet",
]
