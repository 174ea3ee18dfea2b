"""Reading and writing the fact and dimension tables."""

from paneloom.sources.readers import (
    assemble_tickers,
    catalogue_counts,
    first_available,
    latest_snapshot,
    read_catalogue,
    read_factor,
    read_factors,
    read_price,
    resolve_factors,
)
from paneloom.sources.writers import (
    append_table,
    dataset_name,
    export_scalars,
    tag_run,
    truncate_table,
    upsert_table,
    write_clustered,
    write_zone,
)

__all__ = [
    "append_table",
    "assemble_tickers",
    "catalogue_counts",
    "dataset_name",
    "export_scalars",
    "first_available",
    "latest_snapshot",
    "read_catalogue",
    "read_factor",
    "read_factors",
    "read_price",
    "resolve_factors",
    "tag_run",
    "truncate_table",
    "upsert_table",
    "write_clustered",
    "write_zone",
]
