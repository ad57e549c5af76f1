"""Row fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator and NULL text of the published row hash.
HASH_SEPARATOR = "|"
HASH_NULL = "NULL"


def row_hash_of(columns: Sequence[Column]) -> Column:
    texts = [F.coalesce(c.cast("string"), F.lit(HASH_NULL)) for c in columns]
    return F.md5(F.concat_ws(HASH_SEPARATOR, *texts))


def stable_bucket(columns: Sequence[Column], buckets: int) -> Column:
    """A repeatable bucket number, the same on a task's second try."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")
