"""Sinks and the incremental-load gate."""

from hearth.sinks.tables import (
    cluster_for_write, write_replace, write_append, write_create, write_jdbc, drop_table, overwrite_partitions, overwrite_periods, read_table, table_exists, delete_period,
    GateResult, freshness_gate, latest_loaded, write_periods, swap_in, recover_swap, partition_values, dimension_snapshot,
    snapshot_view, export_csv, export_sample,
)
from hearth.sinks.catalog import declared_ddl, create_declared, replace_declared, insert_declared, drop_declared
