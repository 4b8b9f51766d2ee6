"""Joins of a large table to a lookup, decided by the measured size of the lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortline.plans.durable import freeze

# A lookup of at most this many bytes is sent to all executors.
BROADCAST_BYTES = 64 << 20
# Bytes of a fixed-width value, and of the frame of one without a fixed width.
_FIXED, _FRAME = 8, 16


def _bytes_of(name: str, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(name), F.lit(0)) + _FRAME
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0)) + _FRAME
    return F.lit(_FIXED)


def table_bytes(df: DataFrame) -> int:
    """Rough size of the rows in memory, in one pass."""
    row = sum((_bytes_of(f.name, f.dataType) for f in df.schema.fields), F.lit(_FRAME))
    return df.agg(F.sum(row.cast("long"))).first()[0] or 0


def attach(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join a large table to a lookup.

    The lookup is written first, so its size is known and not guessed: a small
    one is broadcast, and the large table then does not move at all. Beyond the
    bound both sides are shuffled, and adaptive execution splits the partitions
    of hot keys of the large side.
    """
    lookup = freeze(lookup)
    small = table_bytes(lookup) <= broadcast_bytes
    return df.join(F.broadcast(lookup) if small else lookup, list(on), how)
