"""Semi-joins while reading: exact bitmaps of wanted numeric ids, tested row by row before any shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bitmaps that are broadcast at most: one of 4 KB for each 32,768 numbers of which at least one is wanted, so 64 MB.
MOST = 16_384


def bitmaps(ids: DataFrame, key: str) -> DataFrame:
    """(bucket, bits): a bitmap for each range of 32,768 ids. Equal ids and null count once and not at all."""
    n = F.col(key).cast("bigint")
    return ids.where(n.isNotNull()).groupBy(F.bitmap_bucket_number(n).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("bits"))


def has_bit(bits: Column, position: Column) -> Column:
    """Whether the bit is set; positions from 0, the lowest bit of a byte first."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def wanted(rows: DataFrame, ids: DataFrame, key: str, id_key: str | None = None, most: int = MOST) -> DataFrame:
    """The rows whose integer key is among ids: the left semi join, by bitmaps in the tasks that read the rows.

    Where the wanted ids lie in more than `most` ranges, bitmaps would be too large to broadcast, and it is Spark's own semi join.
    """
    found = bitmaps(ids, id_key or key)
    if found.limit(most + 1).count() > most:
        other = ids.select(F.col(id_key or key).alias("__id")).distinct()
        return rows.join(other, F.col(key) == F.col("__id"), "left_semi")
    n = F.col(key).cast("bigint")
    near = rows.join(F.broadcast(found), F.bitmap_bucket_number(n) == F.col("bucket"))
    return near.where(has_bit(F.col("bits"), F.bitmap_bit_position(n))).select(*rows.columns)
