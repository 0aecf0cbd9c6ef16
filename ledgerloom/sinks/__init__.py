from ledgerloom.sinks.snapshots import (
    Snapshot,
    VersionConflict,
    expire_snapshots,
    latest_snapshot,
    read_snapshot,
    list_snapshots,
    release_shuffles,
    write_snapshot,
)
from ledgerloom.sinks.tables import (
    ensure_database,
    new_scratch_folder,
    read_back,
    register_snapshot,
    save_parquet,
    save_table,
    side_by_side,
    snapshot_root,
    table_snapshot,
)

__all__ = [
    "Snapshot",
    "VersionConflict",
    "ensure_database",
    "expire_snapshots",
    "latest_snapshot",
    "new_scratch_folder",
    "read_back",
    "read_snapshot",
    "register_snapshot",
    "release_shuffles",
    "save_parquet",
    "save_table",
    "side_by_side",
    "snapshot_root",
    "table_snapshot",
    "list_snapshots",
    "write_snapshot",
]
