from tarmac.sinks.files import publish, to_topic_lines, write_clean, write_flights  # noqa: F401
from tarmac.sinks.tables import (  # noqa: F401
    committed_batches,
    compact_in_place,
    expire_batches,
    read_all,
    read_latest,
    read_snapshot,
    snapshot_batch,
    upsert_batch,
)
