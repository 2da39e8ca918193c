from triploom.sources.checkpoints import cut_lineage, ensure_checkpoint_dir
from triploom.sources.readers import (
    read_edges,
    read_locations,
    read_trips,
    read_vertices,
)
from triploom.sources.stages import digest_of, is_current, read_stage, stage_digest, write_stage
from triploom.sources.writers import write_csv

__all__ = [
    "cut_lineage",
    "digest_of",
    "ensure_checkpoint_dir",
    "is_current",
    "read_edges",
    "read_locations",
    "read_stage",
    "read_trips",
    "read_vertices",
    "stage_digest",
    "write_csv",
    "write_stage",
]
