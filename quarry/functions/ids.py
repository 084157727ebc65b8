"""Two 32-bit ids packed into one 64-bit key, and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOW_MASK = 0xFFFFFFFF


def pack_pair_id(hi: Column, lo: Column) -> Column:
    """``hi << 32 | lo`` with ``lo`` taken as an unsigned 32-bit value."""
    return F.shiftleft(hi.cast("bigint"), 32).bitwiseOR(lo.cast("bigint").bitwiseAND(F.lit(LOW_MASK)))


def pair_id_high(pair_id: Column) -> Column:
    return F.shiftright(pair_id, 32)


def pair_id_low(pair_id: Column) -> Column:
    return pair_id.bitwiseAND(F.lit(LOW_MASK))
