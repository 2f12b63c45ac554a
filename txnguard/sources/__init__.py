from txnguard.sources.fixtures import (
    baseline, blacklist_long, blacklist_users, known_devices, transaction_source, transactions,
)
from txnguard.sources.reference import (
    build_baseline, build_known_devices, read_jdbc, read_snapshot, write_snapshot,
)
from txnguard.sources.tables import read_table, table_path

__all__ = ["baseline", "blacklist_long", "blacklist_users", "known_devices", "transaction_source",
           "transactions", "build_baseline", "build_known_devices", "read_jdbc", "read_snapshot",
           "write_snapshot", "read_table", "table_path"]
