from .buckets import Buckets
from .landing import (
    latest_partition,
    read_entity,
    read_json_lines,
    read_partition,
    write_json_lines,
    write_partition,
)
from .manifest import Manifest
from .registry import ENTITIES, LOAD_ORDER, Entity, entity, raw_path
from .snapshots import Snapshots
from .state import RunState

__all__ = [
    "Buckets",
    "ENTITIES",
    "Entity",
    "LOAD_ORDER",
    "Manifest",
    "RunState",
    "Snapshots",
    "entity",
    "latest_partition",
    "raw_path",
    "read_entity",
    "read_json_lines",
    "read_partition",
    "write_json_lines",
    "write_partition",
]
