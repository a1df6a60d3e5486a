"""Column expressions built from Spark's JVM-side functions."""

from .hashing import hash32, hash_bucket, hash_unit
from .timefeat import cube_root, day_part, hhmm_to_minutes

__all__ = ["cube_root", "day_part", "hash32", "hash_bucket", "hash_unit", "hhmm_to_minutes"]
