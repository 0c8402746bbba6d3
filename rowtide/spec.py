"""What one lake table looks like: key, precedence columns, buckets, policy."""

from __future__ import annotations

from dataclasses import dataclass

# Columns that decide which of two changes is the later one.
STREAM_ORDER = ("date_action", "log_position")
BATCH_ORDER = ("__source_ts_ms", "__source_pos")

# Bookkeeping columns of a stored row.
DELETED = "_deleted"
BATCH = "_batch"
BUCKET = "_bucket"
BOOKKEEPING = (DELETED, BATCH, BUCKET)

EVENT_ORDER = "event_order"
ARRIVAL = "arrival"


@dataclass(frozen=True)
class TableSpec:
    database: str
    table: str
    keys: tuple[str, ...]
    order: tuple[str, ...] = STREAM_ORDER
    buckets: int | None = None  # None: from the bytes of the first load
    policy: str = EVENT_ORDER

    def __post_init__(self):
        if self.policy not in (EVENT_ORDER, ARRIVAL):
            raise ValueError(f"unknown merge policy {self.policy!r}")
        if not self.keys:
            raise ValueError("a lake table needs at least one key column")


def split_keys(table_id: str) -> tuple[str, ...]:
    """``"a, b"`` in a control row means the composite key (a, b)."""
    return tuple(part.strip() for part in table_id.split(",") if part.strip())


def buckets_for(table_bytes: int, bucket_bytes: int = 512 << 20) -> int:
    """Power-of-two bucket count that keeps one bucket near ``bucket_bytes``, whatever the size."""
    wanted = max(1, -(-table_bytes // bucket_bytes))
    return 1 << (wanted - 1).bit_length()
