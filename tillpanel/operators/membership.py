"""Rows whose key may be among the keys of another table, told by a bitmap of fixed size.

A join shuffles both of its sides, also the rows that find no partner. Where few rows find one, a bitmap
of the hashes of the wanted keys keeps most of the others out of the shuffle. It lets every wanted row
pass and some others, so the join behind it decides; a bitmap that fills up only lets more rows pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 64-bit words of the bitmap: at most so many rows are broadcast, whatever the number of keys.
WORDS = 1 << 18


def possible_members(frame: DataFrame, key: Column, members: DataFrame, member_key: Column) -> DataFrame:
    """The rows of ``frame`` whose ``key`` may be a ``member_key`` of ``members``; null is a key too."""
    return told_apart(frame, key, members, member_key)[0]


def told_apart(
    frame: DataFrame, key: Column, members: DataFrame, member_key: Column
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``frame`` that ``possible_members`` gives, and all others; a null key is among one of them."""

    def place(column: Column) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(WORDS * 64))

    at = place(member_key)
    bit = F.expr("shiftleft(1L, CAST(member_place % 64 AS INT))")
    bitmap = (
        members.select(at.alias("member_place"))
        .groupBy(F.floor(F.col("member_place") / 64).alias("member_word"))
        .agg(F.bit_or(bit).alias("member_bits"))
    )
    # As a struct, so that columns of these names in the input do no harm.
    looked_up = (
        frame.select(F.struct(*[F.col(f"`{c}`") for c in frame.columns]).alias("key_row"), place(key).alias("key_place"))
        # At most WORDS rows.
        .join(F.broadcast(bitmap), F.floor(F.col("key_place") / 64) == F.col("member_word"), "left")
    )
    word = F.coalesce("member_bits", F.lit(0).cast("long"))
    is_set = F.getbit(word, F.pmod("key_place", F.lit(64)).cast("int")) == 1
    return tuple(looked_up.filter(wanted).select("key_row.*") for wanted in (is_set, ~is_set))
