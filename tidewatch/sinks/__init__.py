from tidewatch.sinks.tables import (
    append_table,
    overwrite_partitions,
    rebalance,
    write_csv,
    write_json_lines,
    write_manifest,
    write_samples,
    write_table,
)
from tidewatch.sinks.versions import publish_partitions, publish_version, published, read_published, version_rows, write_version

__all__ = [
    "append_table",
    "overwrite_partitions",
    "publish_partitions",
    "publish_version",
    "published",
    "read_published",
    "rebalance",
    "version_rows",
    "write_csv",
    "write_json_lines",
    "write_manifest",
    "write_samples",
    "write_table",
    "write_version",
]
