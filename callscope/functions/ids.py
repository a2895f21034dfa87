"""Identifier helpers: UUID checks and retry-stable generated keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a UUID of version 1-5 with variant 8, 9, a or b, any case.
UUID_PATTERN = r"^(?i)[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}\z"


def is_uuid(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.rlike(UUID_PATTERN)


def hex_as_uuid(hex32: Column) -> Column:
    """Lay 32 hex digits out as 8-4-4-4-12 (no version forced)."""
    return F.concat_ws("-", F.substring(hex32, 1, 8), F.substring(hex32, 9, 4),
                       F.substring(hex32, 13, 4), F.substring(hex32, 17, 4),
                       F.substring(hex32, 21, 12))


def stable_uuid(seed: Column) -> Column:
    """A version-4 shaped UUID from the md5 of `seed`.

    Unlike `uuid()`, a retried task gives the same key, so reruns after an
    executor loss do not create new feedback keys.
    """
    h = F.md5(seed.cast("string"))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-4"),
                    F.substring(h, 14, 3), F.lit("-a"), F.substring(h, 18, 3), F.lit("-"),
                    F.substring(h, 21, 12))
