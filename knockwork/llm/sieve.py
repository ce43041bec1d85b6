"""Which rows of a large table may have a key of a small one, told without moving the rows.

The keys set bits in 64-bit blocks of a Bloom filter; the blocks are broadcast and every row
looks at the one block that its key falls into. Rows that surely have none of the keys can stay
where they are; the rest, those with a key and a few others, go on to an exact join, so no
result depends on the filter. Its size is bounded: with keys far beyond ``MOST_BLOCKS`` times
sixteen it lets every row through and the join moves the table, as it would without it.

Null keys are never in the set. An empty set holds no row; an empty table gives two empty ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knockwork.llm.scratch import Scratch

#: Most blocks that are broadcast, a long each beside its number.
MOST_BLOCKS = 1 << 19
#: Keys for which a block is made, and bits that each key sets in it.
KEYS_PER_BLOCK, BITS = 2, 3


def free(name: str, columns: list[str]) -> str:
    """A column name that none of ``columns`` has."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


class Sieve:
    """Made of the values of a hash column; ``split`` parts other tables by it."""

    def __init__(self, keys: DataFrame, hashed: Column, scratch: Scratch):
        n = keys.count()
        self.blocks = 1
        while self.blocks < MOST_BLOCKS and self.blocks * KEYS_PER_BLOCK < n:
            self.blocks *= 2
        given = keys.select(hashed.alias("h")).filter("h is not null")
        bits = given.groupBy(self._block(F.col("h")).alias("block")).agg(F.bit_or(self._mask(F.col("h"))).alias("bits"))
        self.bits = scratch.keep(bits, "sieve")

    def _block(self, h: Column) -> Column:
        return F.xxhash64(h).bitwiseAND(F.lit(self.blocks - 1).cast("long"))

    def _mask(self, h: Column) -> Column:
        mask = None
        for i in range(BITS):
            place = F.shiftrightunsigned(F.xxhash64(h), 40 + 6 * i).bitwiseAND(F.lit(63)).cast("int")
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
            mask = bit if mask is None else mask.bitwiseOR(bit)
        return mask

    def split(self, rows: DataFrame, hashed: Column) -> tuple[DataFrame, DataFrame]:
        """(rows that may have a key, rows that surely have none), with the columns of ``rows``."""
        block, bits, held, key = (free(f"sieve_{x}", rows.columns) for x in ("block", "bits", "held", "key"))
        given = rows.withColumn(held, hashed)
        table = F.broadcast(self.bits.select(F.col("block").alias(block), F.col("bits").alias(bits)))
        mask = self._mask(F.col(held))
        told = given.withColumn(key, self._block(F.col(held))).join(table, F.col(key) == F.col(block), "left")
        inside = F.coalesce(F.col(bits).bitwiseAND(mask) == mask, F.lit(False)) & F.col(held).isNotNull()
        return told.filter(inside).select(*rows.columns), told.filter(~inside).select(*rows.columns)
