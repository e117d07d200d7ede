"""Hold-out by the checksum of an id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def id_remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text modulo ``divisor``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % divisor
