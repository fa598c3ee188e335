from tripkpi.sources.readers import (
    SAMPLE_SEED,
    file_sample,
    hash_sample,
    in_hash_sample,
    read_by_layout,
    read_first_available,
    read_trips,
    row_sample,
    sample_trips,
    unite,
)
from tripkpi.sources.sinks import reload_clean, write_clean

__all__ = [
    "SAMPLE_SEED",
    "file_sample",
    "hash_sample",
    "in_hash_sample",
    "read_by_layout",
    "read_first_available",
    "read_trips",
    "reload_clean",
    "row_sample",
    "sample_trips",
    "unite",
    "write_clean",
]
