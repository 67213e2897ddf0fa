"""Bit flags packed in an integer column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def get_bit(flags: Column, bit: int) -> Column:
    return F.shiftright(flags.cast("int"), bit).bitwiseAND(F.lit(1))


def set_bit(flags: Column, bit: int, value: Column, where: Column | None = None) -> Column:
    """Write one bit; rows not in ``where`` keep theirs."""
    mask = 1 << bit
    base = flags.cast("int")
    on = base.bitwiseOR(F.lit(mask))
    off = base.bitwiseAND(F.lit(~mask))
    written = F.when(value.cast("boolean"), on).otherwise(off)
    return written if where is None else F.when(where, written).otherwise(base)


def pack_bits(bits: dict[int, Column]) -> Column:
    """Byte from one boolean (or 0/1) column per bit."""
    parts = [F.coalesce(c.cast("boolean").cast("int"), F.lit(0)) * F.lit(1 << b) for b, c in bits.items()]
    return reduce(lambda a, b: a + b, parts, F.lit(0))


def unpack_bits(flags: Column, width: int = 8) -> Column:
    """Array of the bits, lowest first."""
    return F.array(*[get_bit(flags, b) for b in range(width)])


def bandmath(bits: dict[int, Column | str]) -> Column:
    """Flag byte from a user expression per bit (``Column`` or SQL text)."""
    return pack_bits({b: F.expr(e) if isinstance(e, str) else e for b, e in bits.items()})
