from gridledger.sources.months import changed_months, diff_published, publish
from gridledger.sources.store import (
    append_snapshot,
    read_table,
    reset_status,
    rotate,
)

__all__ = [
    "append_snapshot", "changed_months", "diff_published", "publish", "read_table", "reset_status", "rotate",
]
